from __future__ import annotations

import json
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from palaver.session import configure  # noqa: E402
from palaver.sources.landed import read_lines  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[4]").appName("tests")
    builder = configure(builder, cores=4)
    builder = builder.config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.sql.shuffle.partitions", "4")
    builder = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def land(tmp_path):
    """Writes records (dicts or raw lines) as one landed file and returns the folder."""

    def write(records, folder="landing"):
        target = tmp_path / folder
        target.mkdir(parents=True, exist_ok=True)
        lines = [r if isinstance(r, str) else json.dumps(r, separators=(",", ":")) for r in records]
        (target / f"{uuid.uuid4().hex}.json").write_text("".join(line + "\n" for line in lines))
        return str(target)

    return write


@pytest.fixture
def landed(spark, land):
    """Lines of records as the readers deliver them."""
    return lambda records: read_lines(spark, land(records, uuid.uuid4().hex))


ID_STEP = 1 << 22


def message(number, seq=None, **fields):
    """A landed message; ``number`` counts milliseconds, so ids are ordered by it."""
    record = {
        "id": str(number * ID_STEP),
        "channel_id": "10",
        "author": {"id": "7", "username": "ann", "bot": False},
        "content": f"text {number}",
        "tts": False,
        "pinned": False,
        "kind": "0",
        "mentions": [],
        "attachments": [],
        "embeds": [],
        "components": [],
        "reactions": [],
        "arrival_seq": number if seq is None else seq,
    }
    record.update(fields)
    return record
