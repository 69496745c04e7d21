"""Ledgers of a lake: which files were landed, which days were written.

* ``files``: one row per landed file version (file, modified, size).  A
  landing parses only versions that are not in it; a file that comes again
  with another time or size is a new version, and its older versions are
  superseded: their bronze rows no longer count.
* ``touched``: one row per (source, batch, event date) that a bronze writer
  has written, with a mark of the write.  A run rebuilds the days that are
  touched and not yet consumed, then files them as consumed, after it has
  published.  A failure in between leaves them pending; rebuilding a day
  twice gives the same day.

Both grow with files and days, not with rows; they are Parquet tables,
written by one folder per run or batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.sources.storage import exists

FILES = "file string, path string, modified timestamp, size long, run string"
TOUCHED = "event_date date, rows long, mark string, batch string"
CONSUMED = "source string, event_date date, mark string, batch string, run string"


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or no rows where nothing was written yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def listed_files(spark: SparkSession, landing: str) -> DataFrame:
    """(file, path, modified, size) of the files below a landing folder;
    contents are not read."""
    if not exists(spark, landing):
        return spark.createDataFrame([], "file string, path string, modified timestamp, size long")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
    return found.select(F.col("_metadata.file_path").alias("file"), "path",
                        F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


class Ledger:
    """The ledgers below ``<root>/ledger``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/ledger"

    # -- files ---------------------------------------------------------------------
    def files(self, source: str) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/files/{source}", FILES)

    def new_files(self, source: str, landing: str) -> DataFrame:
        """Versions of the landing's files that no run has parsed."""
        known = self.files(source).select("file", "modified", "size")
        return listed_files(self.spark, landing).join(known, ["file", "modified", "size"], "left_anti")

    def add_files(self, source: str, files: DataFrame, run: str) -> None:
        files.select("file", "path", "modified", "size").write.mode("overwrite") \
            .parquet(f"{self.root}/files/{source}/run={run}")

    def superseded(self, source: str) -> DataFrame:
        """(file, modified) of versions that a later one has replaced."""
        files = self.files(source)
        last = files.groupBy("file").agg(F.max("modified").alias("last"))
        return files.join(last, "file").where("modified < last").select("file", "modified").distinct()

    # -- days ----------------------------------------------------------------------
    def touch(self, source: str, days: DataFrame, batch: str, mark: str) -> None:
        """File the (event_date, rows) that a batch has written."""
        days.select("event_date", "rows", F.lit(mark).alias("mark")).write.mode("overwrite") \
            .parquet(f"{self.root}/touched/{source}/batch={batch}")

    def touched(self, source: str) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/touched/{source}", TOUCHED) \
            .withColumn("source", F.lit(source))

    def pending(self, sources: tuple[str, ...]) -> DataFrame:
        """(source, event_date, batch, mark, rows) written and not consumed."""
        done = read_or_empty(self.spark, f"{self.root}/consumed", CONSUMED).drop("run")
        out = None
        for source in sources:
            rows = self.touched(source)
            out = rows if out is None else out.unionByName(rows)
        return out.where("event_date is not null").join(done, ["source", "event_date", "batch", "mark"], "left_anti")

    def consume(self, entries: DataFrame, run: str) -> None:
        entries.select("source", "event_date", "mark", "batch").distinct().write.mode("overwrite") \
            .parquet(f"{self.root}/consumed/run={run}")


def days_of(rows: DataFrame, day) -> DataFrame:
    """(event_date, rows) of the rows about to be written."""
    return rows.groupBy(day.alias("event_date")).agg(F.count(F.lit(1)).alias("rows"))
