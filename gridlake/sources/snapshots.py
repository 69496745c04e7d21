"""Published tables as versioned snapshots with one moving pointer.

A run writes the parts it rebuilt (days of a mart, months of its moments)
into folders of its own, ``<root>/<table>/run=<run>/<part>``, and checks them
there.  Publishing writes one small manifest, (name, part, run) of every
part of every table: those of the version before, less the replaced parts,
plus the run's own.  The pointer is the greatest committed manifest; Spark
commits it with its ``_SUCCESS`` file, after all tables are written.  So all
tables move together: readers see the version before until then, whatever
fails, and parts that a rerun no longer fills disappear in the same step.

Manifests grow with parts, not rows.  ``read_version`` reads an earlier
version; ``expire`` drops old manifests and the folders only they name.
Two runs that publish from the same version conflict: the second fails
and publishes nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.sources.storage import located, remove

MANIFEST = "name string, part string, run string"
WHOLE = "part=all"           # the part of a table that is always rewritten


class PublishConflict(RuntimeError):
    """Another run has published since this one began."""


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, ascending."""
    fs, pattern = located(spark, f"{root}/_manifests/version=*/_SUCCESS")
    found = fs.globStatus(pattern) or []
    return sorted(int(re.search(r"version=(\d+)", s.getPath().toString())[1]) for s in found)


def current(spark: SparkSession, root: str) -> int:
    """The published version; 0 before the first."""
    return max(versions(spark, root), default=0)


def _manifest_path(root: str, version: int) -> str:
    return f"{root}/_manifests/version={version:010d}"


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(name, part, run) of every part of a version (the published one)."""
    version = current(spark, root) if version is None else version
    if version == 0:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(_manifest_path(root, version))


def part_folder(root: str, name: str, run: str, part: str = "") -> str:
    return f"{root}/{name}/run={run}" + (f"/{part}" if part else "")


def publish(spark: SparkSession, root: str, base: int, run: str, replaced: DataFrame, added: DataFrame) -> int:
    """Commit the next version: ``base`` without the ``replaced`` (name, part)
    rows, with the ``added`` ones, which lie in the folders of ``run``."""
    if current(spark, root) != base:
        raise PublishConflict(f"version {current(spark, root)} was published after version {base}")
    version = base + 1
    fs, claim = located(spark, f"{root}/_claims/{version:010d}")
    if not fs.createNewFile(claim):
        raise PublishConflict(f"version {version} is being published; remove {claim.toString()} if its run is dead")
    try:
        kept = manifest(spark, root, base).join(replaced.select("name", "part").distinct(), ["name", "part"], "left_anti")
        new = added.select("name", "part").distinct().withColumn("run", F.lit(run))
        kept.join(new.select("name", "part"), ["name", "part"], "left_anti").select("name", "part", "run") \
            .unionByName(new).coalesce(1).write.mode("overwrite").parquet(_manifest_path(root, version))
    finally:
        fs.delete(claim, False)
    return version


def read_version(spark: SparkSession, root: str, name: str, schema, version: int | None = None,
                 only: list[str] | None = None) -> DataFrame:
    """Rows of a table in a version (the published one); ``schema`` holds its
    partition column too, ``only`` limits it to some parts.  Only the folders
    of the version's own parts are listed."""
    parts = manifest(spark, root, version).where(F.col("name") == name)
    if only is not None:
        parts = parts.where(F.col("part").isin(only))
    folders = sorted(part_folder(root, name, r["run"], r["part"]) for r in parts.collect())     # one per part
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not folders:
        return spark.createDataFrame([], wanted)
    placed = T.StructType(wanted.fields + [T.StructField(c, T.StringType()) for c in ("run", "part")])
    return spark.read.schema(placed).option("basePath", f"{root}/{name}").parquet(*folders).drop("run", "part")


def expire(spark: SparkSession, root: str, keep: int = 10) -> list[str]:
    """Drop all but the last ``keep`` versions and the run folders that only
    those name; returns the dropped folders."""
    old, live = versions(spark, root)[:-keep], versions(spark, root)[-keep:]
    if not old:
        return []

    def runs(which: list[int]) -> DataFrame:
        return spark.read.schema(MANIFEST).parquet(*[_manifest_path(root, v) for v in which]).select("name", "run").distinct()

    gone = [part_folder(root, r["name"], r["run"]) for r in runs(old).join(runs(live), ["name", "run"], "left_anti").collect()]
    for folder in [_manifest_path(root, v) for v in old] + gone:
        remove(spark, folder)
    return gone
