"""Writes to a database table that happen once, whatever tasks and drivers are lost."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Protocol

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.plans import Scratch
from tallyframe.sources.jdbc import BATCH_ROWS, WRITE_CONNECTIONS, jdbc_write

# Columns of the staging table that make each of its rows unique.
PART, ROW = "stage_part", "stage_row"
# The table that remembers finished runs.
RUNS = "staged_runs"
# Attempts to write the parts that are missing.
ATTEMPTS = 4

RUN_NAME = re.compile(r"[A-Za-z0-9_]{1,64}")


class Database(Protocol):
    """What a staged write asks of a database."""

    def create(self, empty: DataFrame, table: str) -> None:
        """Create ``table`` with the columns of a frame, in place of an older one."""

    def append(self, rows: DataFrame, table: str, connections: int) -> None:
        """Add rows, one transaction per partition."""

    def rows(self, statement: str) -> list[tuple]:
        """The rows of a query, few of them."""

    def transaction(self, *statements: str) -> None:
        """Run statements together: all of them take effect, or none."""


class JdbcDatabase:
    """A database behind Spark's JDBC source; statements run on a connection of the driver."""

    def __init__(self, spark: SparkSession, url: str, properties: Mapping[str, str]):
        self.spark, self.url, self.properties = spark, url, properties

    def create(self, empty: DataFrame, table: str) -> None:
        jdbc_write(empty, self.url, table, "overwrite", self.properties, 1)

    def append(self, rows: DataFrame, table: str, connections: int) -> None:
        options = {"batchsize": BATCH_ROWS, **self.properties, "url": self.url, "dbtable": table}
        rows.write.format("jdbc").options(**options).mode("append").save()

    def rows(self, statement: str) -> list[tuple]:
        options = {**self.properties, "url": self.url, "dbtable": f"({statement}) asked"}
        return [tuple(r) for r in self.spark.read.format("jdbc").options(**options).load().collect()]

    def transaction(self, *statements: str) -> None:
        jvm = self.spark._jvm
        if driver := self.properties.get("driver"):
            jvm.java.lang.Class.forName(driver)
        given = jvm.java.util.Properties()
        for name, value in self.properties.items():
            given.setProperty(name, str(value))
        connection = jvm.java.sql.DriverManager.getConnection(self.url, given)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for text in statements:
                statement.execute(text)
            connection.commit()
        finally:
            connection.close()


def jdbc_staged_write(
    df: DataFrame,
    url: str,
    table: str,
    mode: str,
    properties: Mapping[str, str],
    run: str,
    connections: int = WRITE_CONNECTIONS,
    database: Database | None = None,
    folder: str | None = None,
) -> int:
    """Append ``df`` to ``table``, or put it in place of its rows, exactly once.

    ``run`` names the write, in letters, digits and underscores: whoever starts it again under the same name, after
    whatever failure, gets the rows written once. ``mode`` is ``append`` or ``overwrite``;
    ``table`` exists and has the columns of ``df``. Returns the number of rows written.

    1. A run that is noted as finished in the table ``staged_runs`` is not done again.
    2. The rows are numbered within ``connections`` parts and written as a durable table
       in ``folder``, by default the one for intermediate tables, so a task that runs again has the same rows under the same numbers.
    3. They go to a staging table of their own, unique by part and row. A part is one
       transaction. The second copy of a part, from a task that was lost after it had
       committed, breaks the unique key and is refused, which may end the Spark job.
    4. So the database is asked which parts it has, whether the job ended well or not.
       Parts with another number of rows than there should be are deleted, and those
       missing are written again, ATTEMPTS times in all.
    5. With all parts there, one transaction moves the rows: it empties the table if
       ``overwrite`` is wanted, copies the staging table and notes the run as finished.
    6. The staging table goes. If the driver is lost before, the next start with this
       name finds the note and only removes the table.

    Readers see the rows before or after, never a part of them. The database has to
    support transactions and ``CREATE TABLE IF NOT EXISTS``; ``staged_runs`` has the
    column ``run`` as its key. The driver connects to the database for steps 1, 4, 5 and 6.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be append or overwrite, not {mode!r}")
    if not RUN_NAME.fullmatch(run):
        raise ValueError("run must be up to 64 letters, digits and underscores")
    if taken := {PART, ROW} & set(map(str.lower, df.columns)):
        raise ValueError(f"columns {sorted(taken)} are needed for staging")
    if connections < 1:
        raise ValueError("connections must be positive")
    database = database or JdbcDatabase(df.sparkSession, url, properties)
    stage = f"{table}_stage_{run}"
    database.transaction(f"CREATE TABLE IF NOT EXISTS {RUNS} (run VARCHAR(64) PRIMARY KEY, n BIGINT)")
    if done := database.rows(f"SELECT n FROM {RUNS} WHERE run = '{run}'"):
        database.transaction(f"DROP TABLE IF EXISTS {stage}")
        return int(done[0][0])
    with Scratch(df.sparkSession, folder) as owned:
        # A part is what one task of the first write has; the number of its row comes
        # from the low bits of the id, which count within the task.
        numbered = owned.keep(
            df.repartition(connections)
            .withColumn(PART, F.spark_partition_id())
            .withColumn(ROW, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        )
        wanted = {part: n for part, n in numbered.groupBy(PART).count().collect()}
        database.create(numbered.limit(0), stage)
        database.transaction(f"CREATE UNIQUE INDEX {stage.replace('.', '_')}_key ON {stage} ({PART}, {ROW})")
        _fill(database, numbered, stage, wanted, connections)
    total = sum(wanted.values())
    names = ", ".join(df.columns)
    database.transaction(
        *([f"DELETE FROM {table}"] if mode == "overwrite" else []),
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage}",
        f"INSERT INTO {RUNS} (run, n) VALUES ('{run}', {total})",
    )
    database.transaction(f"DROP TABLE IF EXISTS {stage}")
    return total


def _fill(
    database: Database, numbered: DataFrame, stage: str, wanted: dict[int, int], connections: int
) -> None:
    """Write the parts until the database has all of them, whole."""
    failure: Exception | None = None
    for _ in range(ATTEMPTS):
        found = dict(database.rows(f"SELECT {PART}, COUNT(*) AS n FROM {stage} GROUP BY {PART}"))
        broken = sorted(part for part, n in found.items() if n != wanted.get(part))
        if broken:
            database.transaction(f"DELETE FROM {stage} WHERE {PART} IN ({', '.join(map(str, broken))})")
        missing = sorted(part for part in wanted if found.get(part) != wanted[part])
        if not missing:
            return
        # Whole parts in each partition, as a partition is one transaction.
        rows = numbered.where(F.col(PART).isin(missing)).repartition(min(connections, len(missing)), PART)
        try:
            database.append(rows, stage, connections)
        except (PySparkException, Py4JJavaError) as error:
            failure = error
    found = dict(database.rows(f"SELECT {PART}, COUNT(*) AS n FROM {stage} GROUP BY {PART}"))
    if found != wanted:
        raise RuntimeError(f"{stage} has parts missing after {ATTEMPTS} attempts") from failure
