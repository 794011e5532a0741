"""What the JDBC functions ask of Spark. No database is started for these tests."""

from __future__ import annotations

from datetime import date

import pytest

from tallyframe import jdbc_scan, jdbc_write
from tests.helpers import plan_of


class Recorder:
    """Stands in for a session, a reader, a frame and a writer."""

    def __init__(self, row=None, speculation="false"):
        self.row = row
        self.speculation = speculation
        self.calls = []
        self.read = self.write = self.sparkSession = self.conf = self

    def get(self, name, default):
        return self.speculation if name == "spark.speculation" else default

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.calls.append(options)
        return self

    def repartition(self, count):
        self.parts = count
        return self

    def mode(self, mode):
        self.calls[-1]["mode"] = mode
        return self

    def load(self):
        return self

    def save(self):
        self.calls[-1]["saved"] = True

    def first(self):
        return self.row


URL = "jdbc:mysql://db.example/shop"


def test_plain_scan():
    spark = Recorder()
    jdbc_scan(spark, URL, "orders", {"user": "u"})
    assert spark.calls == [{"fetchsize": "10000", "user": "u", "url": URL, "dbtable": "orders"}]


def test_ranges_with_given_bounds():
    spark = Recorder()
    jdbc_scan(spark, URL, "orders", {"fetchsize": "5"}, "day", date(2024, 1, 1), date(2024, 2, 1), 4)
    assert spark.calls == [
        {
            "fetchsize": "5",
            "url": URL,
            "dbtable": "orders",
            "partitionColumn": "day",
            "lowerBound": "2024-01-01",
            "upperBound": "2024-02-01",
            "numPartitions": "4",
        }
    ]


def test_bounds_come_from_the_database_if_not_given():
    spark = Recorder(row=(3, 900))
    jdbc_scan(spark, URL, "orders", {}, key="id", partitions=8)
    asked, scan = spark.calls
    assert asked["dbtable"] == "(SELECT MIN(id) AS lo, MAX(id) AS hi FROM orders) bounds"
    assert (scan["lowerBound"], scan["upperBound"], scan["numPartitions"]) == ("3", "900", "8")


def test_table_without_keys_is_read_whole():
    spark = Recorder(row=(None, None))
    jdbc_scan(spark, URL, "orders", {}, key="id", partitions=8)
    assert "partitionColumn" not in spark.calls[-1]


@pytest.mark.parametrize(
    "arguments",
    [
        {"key": "id"},
        {"partitions": 3},
        {"key": "id", "partitions": 3, "lower": 1},
        {"lower": 1, "upper": 2},
        {"key": "id", "partitions": 0, "lower": 1, "upper": 2},
    ],
)
def test_incomplete_ranges(arguments):
    with pytest.raises(ValueError):
        jdbc_scan(Recorder(), URL, "orders", {}, **arguments)


def test_write():
    frame = Recorder()
    jdbc_write(frame, URL, "result", "overwrite", {"truncate": "true"}, connections=7)
    assert frame.parts == 7
    assert frame.calls == [
        {
            "batchsize": "10000",
            "truncate": "true",
            "url": URL,
            "dbtable": "result",
            "mode": "overwrite",
            "saved": True,
        }
    ]


def test_steps_before_a_write_keep_their_tasks(spark):
    """The bounded partitions come from an exchange, not from merging tasks before it."""
    frame = spark.range(0, 100, 1, 12)
    written = []

    class Writer:
        def format(self, _):
            return self

        options = mode = lambda self, *_, **__: self

        def save(self):
            written.append(self.frame)

    class Frame:
        sparkSession = spark

        def repartition(self, count):
            self.write = Writer()
            self.write.frame = frame.repartition(count)
            return self

    jdbc_write(Frame(), URL, "result", "append", {})
    assert written[0].rdd.getNumPartitions() == 16
    assert "Exchange RoundRobinPartitioning(16)" in plan_of(written[0])
    assert "Coalesce" not in plan_of(written[0])


def test_refused_writes():
    with pytest.raises(ValueError):
        jdbc_write(Recorder(), URL, "result", "upsert", {})
    with pytest.raises(ValueError):
        jdbc_write(Recorder(), URL, "result", "append", {}, connections=0)
    with pytest.raises(ValueError, match="speculation"):
        jdbc_write(Recorder(speculation="true"), URL, "result", "append", {})
