"""Staged tables."""

from types import SimpleNamespace

import pytest

from risklake.operators.stage import even_splits, stage, stage_dir


def session(folder, checkpoint, master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(conf={"spark.checkpoint.dir": folder} if folder else {}, sparkContext=context)


def test_folder_comes_from_the_session():
    assert stage_dir(session("hdfs://shared/x/", None, "yarn")) == "hdfs://shared/x"
    assert stage_dir(session(None, "s3a://shared/y", "yarn")) == "s3a://shared/y"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        stage_dir(session(None, None, "spark://host:7077"))


def test_staged_table_is_cut_from_its_lineage(spark):
    df = stage(spark.range(10).selectExpr("id", "id % 3 as k"), "t")
    assert df.inputFiles()[0].startswith("file:")
    assert sorted(tuple(row) for row in df.collect()) == [(i, i % 3) for i in range(10)]


def test_splits_keep_a_higher_number_of_the_session(spark):
    setting = "spark.sql.files.minPartitionNum"
    spark.conf.set(setting, "1000")
    try:
        with even_splits(spark):
            assert spark.conf.get(setting) == "1000"
        assert spark.conf.get(setting) == "1000"
    finally:
        spark.conf.unset(setting)
