"""Where intermediate files go."""

from __future__ import annotations

import pytest

from palaver.session import scratch_dir


class Fake:
    def __init__(self, master, **settings):
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}
        self.conf = self
        self.sparkContext = type("Context", (), {"master": master})

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_lies_on_shared_storage():
    warehouse = {"spark_sql_warehouse_dir": "file:/w"}
    shared = Fake("spark://m", spark_checkpoint_dir="s3a://b/c/", **warehouse)
    assert scratch_dir(shared, "x").startswith("s3a://b/c/x-")
    assert scratch_dir(Fake("local[2]", **warehouse), "x").startswith("file:/w/_scratch/x-")
    with pytest.raises(ValueError):
        scratch_dir(Fake("spark://m", **warehouse), "x")
