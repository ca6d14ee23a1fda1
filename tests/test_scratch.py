"""Folders of intermediate tables that end with their block."""

import os

import pytest

from eventlens.session import checkpoint_path, drop_folder, ensure_checkpoint_dir, scratch_run
from eventlens.sinks.writers import staged


def _files(path):
    return [f for _, _, names in os.walk(path) for f in names]


def test_a_block_leaves_no_table(spark, tmpdir_path):
    base = ensure_checkpoint_dir(spark)
    before = sorted(os.listdir(base))
    with scratch_run(spark, "outer") as outer:
        kept = staged(spark.range(10), "ten")
        with scratch_run(spark, "inner") as inner:
            assert inner.startswith(outer)
            few = staged(kept.where("id > 7"), "few")
            few.write.parquet(f"{tmpdir_path}/few")
            assert _files(inner)
        assert not os.path.exists(inner) and kept.count() == 10
        assert checkpoint_path(spark, "x").startswith(outer)
    assert sorted(os.listdir(base)) == before
    assert spark.read.parquet(f"{tmpdir_path}/few").count() == 2
    assert checkpoint_path(spark, "x") == f"{base.rstrip('/')}/x"


def test_a_block_that_fails_leaves_no_table(spark):
    with pytest.raises(KeyError):
        with scratch_run(spark) as path:
            staged(spark.range(3), "three")
            raise KeyError
    assert not os.path.exists(path)
    drop_folder(spark, path)  # no folder is no error


def test_a_query_in_a_block(spark):
    import __spark_entry__ as entry
    base = ensure_checkpoint_dir(spark)
    before = sorted(os.listdir(base))
    with scratch_run(spark, "suppress"):
        assert entry.queries()["suppress_alerts"](spark, "/root/testdata/sf0.001").count() > 0
    assert sorted(os.listdir(base)) == before
