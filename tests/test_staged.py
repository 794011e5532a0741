"""The order of a staged write and what it does when tasks or the driver are lost.

No database is started: a table of rows on the driver stands in for it, and for lost
tasks.
"""

from __future__ import annotations

import re

import pytest
from pyspark.errors import PySparkException

from tallyframe import jdbc_staged_write
from tallyframe.sources.staged import ATTEMPTS, RUNS, Database


class Lost(PySparkException):
    def __init__(self):
        super().__init__("a task was lost")


class Tables(Database):
    """Tables of rows; ``faults`` are what happens at each append, in turn."""

    def __init__(self, *faults):
        self.tables = {"target": [(0, "old")]}
        self.runs, self.log, self.faults, self.fail_at = {}, [], list(faults), None

    def create(self, empty, table):
        assert empty.count() == 0 and empty.columns[-2:] == ["stage_part", "stage_row"]
        self.log.append(f"create {table}")
        self.tables[table] = []

    def append(self, rows, table, connections):
        fault = self.faults.pop(0) if self.faults else "none"
        self.log.append(f"append {fault}")
        parts = {}
        for r in map(tuple, rows.collect()):
            parts.setdefault(r[-2], []).append(r)
        assert rows.rdd.getNumPartitions() <= connections
        for i, part in enumerate(sorted(parts)):
            if fault == "lost before" and i == 1:
                raise Lost
            if fault == "torn" and i == 1:
                self.tables[table] += parts[part][:1]
                raise Lost
            # What the unique index refuses.
            assert not {r[-2:] for r in parts[part]} & {r[-2:] for r in self.tables[table]}
            self.tables[table] += parts[part]
        if fault == "lost after":
            raise Lost

    def rows(self, statement):
        if RUNS in statement:
            run = re.search("run = '(.*)'", statement)[1]
            return [(self.runs[run],)] if run in self.runs else []
        table = re.search("FROM (.*) GROUP", statement)[1]
        found = {}
        for r in self.tables[table]:
            found[r[-2]] = found.get(r[-2], 0) + 1
        return list(found.items())

    def transaction(self, *statements):
        before = {k: list(v) for k, v in self.tables.items()}, dict(self.runs)
        for statement in statements:
            self.log.append(statement)
            if self.fail_at and re.match(self.fail_at, statement):
                self.tables, self.runs = before
                raise Lost
            if m := re.match(r"DELETE FROM (\w+) WHERE stage_part IN \((.*)\)", statement):
                gone = set(map(int, m[2].split(", ")))
                self.tables[m[1]] = [r for r in self.tables[m[1]] if r[-2] not in gone]
            elif m := re.match(r"DELETE FROM (\w+)$", statement):
                self.tables[m[1]] = []
            elif m := re.match(rf"INSERT INTO {RUNS} .*VALUES \('(\w+)', (\d+)\)", statement):
                assert m[1] not in self.runs
                self.runs[m[1]] = int(m[2])
            elif m := re.match(r"INSERT INTO (\w+) \((.*)\) SELECT \2 FROM (\w+)", statement):
                self.tables[m[1]] += [r[:-2] for r in self.tables[m[3]]]
            elif m := re.match(r"DROP TABLE IF EXISTS (\w+)", statement):
                self.tables.pop(m[1], None)
            else:
                assert re.match("CREATE (TABLE IF NOT EXISTS|UNIQUE INDEX)", statement)


@pytest.fixture
def frame(spark):
    return spark.range(100).selectExpr("CAST(id AS INT) AS id", "concat('n', id) AS name")


WANTED = sorted((i, f"n{i}") for i in range(100))


def write(frame, tables, mode="append", run="r1"):
    return jdbc_staged_write(frame, "jdbc:x", "target", mode, {}, run, connections=6, database=tables)


def test_statements_in_order(frame):
    tables = Tables()
    assert write(frame, tables, "overwrite") == 100
    assert tables.log == [
        f"CREATE TABLE IF NOT EXISTS {RUNS} (run VARCHAR(64) PRIMARY KEY, n BIGINT)",
        "create target_stage_r1",
        "CREATE UNIQUE INDEX target_stage_r1_key ON target_stage_r1 (stage_part, stage_row)",
        "append none",
        "DELETE FROM target",
        "INSERT INTO target (id, name) SELECT id, name FROM target_stage_r1",
        f"INSERT INTO {RUNS} (run, n) VALUES ('r1', 100)",
        "DROP TABLE IF EXISTS target_stage_r1",
    ]
    assert sorted(tables.tables["target"]) == WANTED and tables.tables.keys() == {"target"}


@pytest.mark.parametrize("faults", [["lost before"], ["lost after"], ["torn", "torn", "lost before"]])
def test_lost_tasks(frame, faults):
    tables = Tables(*faults)
    write(frame, tables)
    assert sorted(tables.tables["target"]) == [(0, "n0"), (0, "old"), *WANTED[1:]]


def test_parts_that_never_arrive(frame):
    tables = Tables(*["torn"] * (ATTEMPTS + 3))
    tables.append = lambda *_: (_ for _ in ()).throw(Lost())
    with pytest.raises(RuntimeError, match="missing"):
        write(frame, tables)
    assert tables.tables["target"] == [(0, "old")] and not tables.runs


@pytest.mark.parametrize("at", ["INSERT INTO target", f"INSERT INTO {RUNS}", "DROP", "CREATE UNIQUE"])
def test_a_lost_driver_starts_again(frame, at):
    tables = Tables()
    tables.fail_at = at
    with pytest.raises(Lost):
        write(frame, tables)
    tables.fail_at = None
    assert write(frame, tables) == 100 == write(frame, tables)
    assert len(tables.tables["target"]) == 101 and tables.tables.keys() == {"target"}
    assert write(frame, tables, run="r2") == 100 and len(tables.tables["target"]) == 201


def test_no_rows(frame):
    tables = Tables()
    assert write(frame.where("id < 0"), tables, "overwrite") == 0
    assert tables.tables["target"] == [] and tables.runs == {"r1": 0}


def test_refused(frame):
    for mode, run in (("upsert", "r"), ("append", "a'b"), ("append", "")):
        with pytest.raises(ValueError):
            write(frame, Tables(), mode, run)
    with pytest.raises(ValueError, match="stage_row"):
        write(frame.withColumnRenamed("name", "Stage_Row"), Tables())
