"""Published versions of a table: a replace that is one atomic step.

Layout of a table folder::

    table/_v-<id>/            Parquet files of one version, never changed
    table/_published/<n>-<id>/part-*.json    one line: version, id, folder, time, counts, buckets

``publish`` writes a version's files, then its one-line manifest.  The
appearance of that single file (a rename of the job's committer, or a put on an
object store) is the publication: before it readers get the old version, after
it the new one, and a run that is killed at any point leaves the table readable.
Readers take the manifest of the greatest (version, id), so two writers that
choose the same number both publish whole tables and agree on which one counts.

Everything but ``expire`` goes through Spark's readers and writers.  Folder names
start with an underscore so that a plain ``spark.read.parquet(table)`` fails
instead of mixing versions; ``read_table`` is the way in.  It also reads a table
that ``write_table`` left as plain files, as long as nothing is published there.

A version may be bucketed: its rows lie in a fixed number of files by the hash of
some columns, sorted within each.  The manifest says how, and ``read_table`` tells
Spark, so that joins, groupings and windows over those columns need no shuffle.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.plans.sinks import Folder, refuse_nulls, write_counted

DATA, PUBLISHED = "_v-", "_published"
MANIFEST = ("version long, id string, folder string, published_at timestamp, counts map<string,long>, "
            "buckets struct<number:int, by:array<string>, sorted:array<string>, columns:string>")
#: Versions that ``expire`` leaves: the current one and the one that readers may still be at.
KEEP = 2
#: Unpublished folders younger than this may belong to a running write.
GRACE_HOURS = 24


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The published versions: ``version, id, folder, published_at, counts, buckets``."""
    if hasattr(spark, "_jvm") and not Folder(spark, f"{path}/{PUBLISHED}").exists():
        return spark.createDataFrame([], MANIFEST)
    try:
        return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(f"{path}/{PUBLISHED}")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], MANIFEST)


def current(spark: SparkSession, path: str, version: int | None = None) -> Row | None:
    """The manifest that counts (of ``version``, if given); None where nothing is published."""
    rows = versions(spark, path)
    if version is not None:
        rows = rows.where(F.col("version") == version)
    found = rows.orderBy(F.desc("version"), F.desc("id")).limit(1).collect()
    return found[0] if found else None


def publish(
    df: DataFrame,
    path: str,
    flags: dict[str, Column] | None = None,
    partition_by: list[str] | None = None,
    sort_within: list[str] | None = None,
    contract: StructType | None = None,
    keep: int | None = None,
    buckets: tuple[int, list[str]] | None = None,
) -> dict[str, int]:
    """Replace the table at ``path`` by a new version; return its counts (see ``sinks.write_counted``).

    ``df`` may read the version it replaces.  A version that breaks ``contract`` is not
    published.  With ``keep`` older versions are expired afterwards.  With ``buckets``
    (number, columns) the version is bucketed and sorted by ``sort_within``; tables that
    are joined on the columns should have the same number.
    """
    spark = df.sparkSession
    own = uuid.uuid4().hex
    counts = write_counted(df, f"{path}/{DATA}{own}", flags, partition_by, sort_within, contract, buckets)
    refuse_nulls(path, counts)
    before = current(spark, path)
    number = before["version"] + 1 if before else 1
    held = F.create_map(*[x for k, v in counts.items() for x in (F.lit(k), F.lit(v).cast("long"))])
    manifest = spark.range(1, numPartitions=1).select(
        F.lit(number).cast("long").alias("version"), F.lit(own).alias("id"), F.lit(f"{DATA}{own}").alias("folder"),
        F.current_timestamp().alias("published_at"), held.alias("counts"), *_layout(df, buckets, sort_within))
    manifest.write.json(f"{path}/{PUBLISHED}/{number:020d}-{own}")
    if keep is not None:
        expire(spark, path, keep)
    return counts


def _layout(df: DataFrame, buckets: tuple[int, list[str]] | None, sort_within: list[str] | None) -> list[Column]:
    if not buckets:
        return []
    number, by = buckets
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return [F.struct(F.lit(number).alias("number"), F.array(*[F.lit(c) for c in by]).alias("by"),
                     F.array(*[F.lit(c) for c in sort_within]).alias("sorted"), F.lit(columns).alias("columns")).alias("buckets")]


def _bucketed(spark: SparkSession, folder: str, own: str, layout: Row) -> DataFrame:
    """A version's files with their layout: a name for them in the session's catalog."""
    name = f"daybook_version_{own}"
    place = Folder(spark, folder).qualified().replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({layout['columns']}) USING parquet "
              f"CLUSTERED BY ({', '.join(layout['by'])}) SORTED BY ({', '.join(layout['sorted'])}) INTO {layout['number']} BUCKETS "
              f"LOCATION '{place}'")
    return spark.table(name)


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table's current version, or an older one that is not yet expired."""
    at = current(spark, path, version)
    if at is not None and at["buckets"]:
        return _bucketed(spark, f"{path}/{at['folder']}", at["id"], at["buckets"])
    if at is not None:
        return spark.read.parquet(f"{path}/{at['folder']}")
    if version is not None:
        raise ValueError(f"{path}: version {version} is not published")
    return spark.read.parquet(path)


def expire(spark: SparkSession, path: str, keep: int = KEEP, grace_hours: float = GRACE_HOURS) -> list[str]:
    """Remove all but the newest ``keep`` versions, and leftovers of killed writes; return what went.

    A version's manifest goes before its files, so no reader is sent to missing files.
    Folders that no manifest names go once they are ``grace_hours`` old (also files that
    ``write_table`` left at the path before its first version).  Needs a session with a
    JVM, as Spark's readers and writers cannot delete.
    """
    if keep < 1:
        raise ValueError("the current version cannot be expired")
    rows = sorted(versions(spark, path).select("version", "id", "folder").collect(), reverse=True)
    if not rows:
        return []
    gone = []
    for row in rows[keep:]:
        Folder(spark, f"{path}/{PUBLISHED}/{row['version']:020d}-{row['id']}").delete()
        Folder(spark, f"{path}/{row['folder']}").delete()
        gone.append(row["folder"])
    kept = {row["folder"] for row in rows[:keep]} | {PUBLISHED}
    oldest = (time.time() - grace_hours * 3600) * 1000
    for name, changed in Folder(spark, path).children():
        if name not in kept and name not in gone and changed <= oldest:
            Folder(spark, f"{path}/{name}").delete()
            gone.append(name)
    return gone
