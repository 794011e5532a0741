from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tallyframe import durable
from tallyframe.plans import FOLDER_SETTING, Scratch, work_folder
from tests.helpers import plan_of


def test_durable_result_is_a_table_in_the_checkpoint_folder(spark):
    frame = spark.range(10).selectExpr("id % 3 AS k", "CAST(NULL AS string) AS s").groupBy("k", "s").count()
    kept = durable(frame)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, frame.collect()))
    assert kept.dtypes == frame.dtypes
    assert "Exchange" not in plan_of(kept)
    assert work_folder(spark).removeprefix("file:") in kept.inputFiles()[0]
    assert "ReadSchema: struct<count:bigint>" in plan_of(kept.select("count"))


def test_two_results_do_not_share_a_table(spark):
    first, second = durable(spark.range(3)), durable(spark.range(5))
    assert (first.count(), second.count()) == (3, 5)


def test_empty_result(spark):
    assert durable(spark.range(3).where("id > 9")).collect() == []


class FakeSession:
    """A session with settings only."""

    def __init__(self, **settings):
        self.settings = {name.replace("_", "."): value for name, value in settings.items()}
        self.conf = self

    def get(self, name, default):
        return self.settings.get(name, default)


def test_the_folder_that_the_cluster_names_comes_first():
    both = FakeSession(spark_checkpoint_dir="hdfs:///shared", spark_tallyframe_dir="hdfs:///own")
    assert work_folder(both) == "hdfs:///shared"
    assert work_folder(FakeSession(spark_tallyframe_dir="hdfs:///own")) == "hdfs:///own"
    assert FOLDER_SETTING == "spark.tallyframe.dir"


def test_no_folder_without_a_setting():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(FakeSession())


def test_tables_go_with_their_block(spark, tmp_path):
    with Scratch(spark, f"file://{tmp_path}") as scratch:
        first = durable(spark.range(5), scratch)
        second = durable(first.selectExpr("id + 1 AS id"), scratch)
        assert len(list(tmp_path.iterdir())) == 2
        scratch.remove(but_last=1)
        assert [row[0] for row in second.sort("id").collect()] == [1, 2, 3, 4, 5]
        assert len(list(tmp_path.iterdir())) == 1
    assert list(tmp_path.iterdir()) == []


def test_a_kept_table_leaves_no_shuffle_files(spark, tmp_path):
    """They go when the table is written, not when the driver collects its garbage."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {found.apply(i).getName() for i in range(found.length()) if found.apply(i).getName().startswith("shuffle_")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = files(), spark.conf.get(setting, None)
    with Scratch(spark, str(tmp_path)) as scratch:
        kept = scratch.keep(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
        assert sorted(tuple(r) for r in kept.collect())[0] == (0, 143)
        until = time.time() + 20
        while files() - before and time.time() < until:
            time.sleep(0.2)
        assert not files() - before
    assert spark.conf.get(setting, None) == was
