"""Shared folders: one base per context, no nesting, an error where executors could not see it."""

import pytest

from ledgerlight.session import checkpoint_dir, drop_scratch, require_local_master, scratch_path


def test_three_hundred_scratch_paths_share_one_base(spark):
    base = checkpoint_dir(spark)
    paths = {scratch_path(spark, "t") for _ in range(300)}
    assert len(paths) == 300
    assert checkpoint_dir(spark) == base
    assert {p.rsplit("/", 1)[0] for p in paths} == {f"{base}/scratch"}


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[3,2,3000]", "k8s://h"])
def test_missing_folder_raises_off_a_local_master(master):
    with pytest.raises(RuntimeError):
        require_local_master(master)


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_local_masters_may_use_a_local_folder(master):
    require_local_master(master)


def test_drop_scratch_removes_only_scratch(spark, tmp_dir):
    p = scratch_path(spark, "t")
    spark.range(3).write.parquet(p)
    assert spark.read.parquet(p).count() == 3
    drop_scratch(spark, p)
    with pytest.raises(Exception):
        spark.read.parquet(p).count()
    with pytest.raises(ValueError):
        drop_scratch(spark, tmp_dir)
