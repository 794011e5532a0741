"""Intermediate results that outlive the executors that made them."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

#: Where intermediate tables go if the cluster names no checkpoint folder. A session
#: setting, as ``spark.checkpoint.dir`` cannot be set once a session runs.
FOLDER_SETTING = "spark.tallyframe.dir"

#: Whether Spark removes the shuffle files of a query when it ends, and not only when the
#: driver happens to collect its garbage.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Written tables that can be removed when their results have been used.

    ``with Scratch(spark) as scratch:`` removes its tables at the end of the block;
    without ``with`` they stay until ``remove`` is called. The folder is the one given,
    else what ``spark.checkpoint.dir`` names, which on a cluster has to be shared, else
    what ``spark.tallyframe.dir`` names. There is no other default.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = (folder or work_folder(spark)).rstrip("/")
        self.paths: list[str] = []

    def path(self) -> str:
        """A new path in the folder, removed with the tables."""
        self.paths.append(f"{self.folder}/tallyframe-{uuid4().hex}")
        return self.paths[-1]

    def keep(self, df: DataFrame, compression: str | None = None) -> DataFrame:
        """Compute ``df`` once, now, and return it as read from a written table.

        The shuffle files of that go at once: the table replaces them. ``compression`` is
        that of the files, if not the one of the session.
        """
        path = self.path()
        before = self.spark.conf.get(CLEANUP_SETTING, None)
        self.spark.conf.set(CLEANUP_SETTING, "true")
        try:
            df.write.parquet(path, compression=compression)
        finally:
            if before is None:
                self.spark.conf.unset(CLEANUP_SETTING)
            else:
                self.spark.conf.set(CLEANUP_SETTING, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, but_last: int = 0) -> None:
        """Delete the tables, all or but for the last few."""
        split = len(self.paths) - but_last
        jvm, hadoop = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        for path in self.paths[:split]:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(hadoop).delete(place, True)
        self.paths = self.paths[split:]

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.remove()


def durable(df: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Compute ``df`` once, now, and return it as read from a written table.

    Parquet, so later reads take only the columns they need. The table belongs to
    ``scratch``; without one it is not deleted, as the result may be used at any time.
    """
    return (scratch or Scratch(df.sparkSession)).keep(df)


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from the settings of the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(FOLDER_SETTING, None)
    if not folder:
        raise ValueError(
            f"set spark.checkpoint.dir or {FOLDER_SETTING} to a folder that all executors share"
        )
    return folder
