"""The entry module without the corpus operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("left_over", [None, "palaver/llm/__pycache__"])
def test_entry_without_corpus_operators(tmp_path, left_over):
    """Also where the removal has left an empty folder."""
    for name in ("palaver", "workbench"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if left_over:
        (tmp_path / left_over).mkdir(parents=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), [n for n in q if n.startswith('op')])"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split(" ", 1)[1].strip() == "[]" and int(done.stdout.split()[0]) > 60
