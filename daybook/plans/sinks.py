"""Sinks: whole-table Parquet replace, with counts taken during the write."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.schemas import contract_null_rows


def write_counted(
    df: DataFrame,
    folder: str,
    flags: dict[str, Column] | None = None,
    partition_by: list[str] | None = None,
    sort_within: list[str] | None = None,
    contract: StructType | None = None,
    buckets: tuple[int, list[str]] | None = None,
) -> dict[str, int]:
    """Write ``df`` as Parquet to a new ``folder``; return its counts.

    ``rows`` and one count per ``flags`` entry (e.g. open days, rows without a
    filing) are gathered by an ``Observation`` while the write runs, so the
    plan executes once.  With ``contract`` the rows that hold a NULL in a
    column it declares non-null are counted too (``null_violations``).  With
    ``buckets`` (number, columns) rows are dealt to that many files by the hash of
    the columns (one shuffle), each sorted by ``sort_within``; the layout is of use
    to readers that know it (``versions.read_table``).
    """
    obs = Observation(f"write_{uuid.uuid4().hex}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(c).alias(name) for name, c in (flags or {}).items()]
    any_null = contract_null_rows(contract) if contract is not None else None
    if any_null is not None:
        metrics.append(F.count_if(any_null).alias("null_violations"))
    observed = df.observe(obs, *metrics)
    if buckets:
        if partition_by or not sort_within:
            raise ValueError("a bucketed table has sort_within and no partition_by")
        number, by = buckets
        # The writer's table is only a name for the folder while it writes.
        name = f"daybook_write_{uuid.uuid4().hex}"
        writer = observed.repartition(number, *by).write.bucketBy(number, *by).sortBy(*sort_within)
        writer.option("path", Folder(df.sparkSession, folder).qualified()).format("parquet").saveAsTable(name)
        df.sparkSession.sql(f"DROP TABLE {name}")
        return {k: int(v) for k, v in obs.get.items()}
    if partition_by:
        # Else every task would write a file into every partition folder; AQE splits the large ones.
        observed = observed.hint("rebalance", *partition_by)
    if sort_within:
        observed = observed.sortWithinPartitions(*(partition_by or []), *sort_within)
    writer = observed.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    return {k: int(v) for k, v in obs.get.items()}


def refuse_nulls(path: str, counts: dict[str, int]) -> None:
    """Raise if a counted write broke its contract."""
    if counts.get("null_violations"):
        raise ValueError(f"{path}: {counts['null_violations']} rows break the non-null contract; the table was not replaced")


def write_table(
    df: DataFrame,
    path: str,
    flags: dict[str, Column] | None = None,
    partition_by: list[str] | None = None,
    sort_within: list[str] | None = None,
    contract: StructType | None = None,
) -> dict[str, int]:
    """Replace the Parquet table at ``path`` with ``df``; return its counts (see ``write_counted``).

    ``partition_by`` (e.g. ``["year"]``) is off by default: a partition column
    is appended to the table's contract.  Rows are then rebalanced by it (one
    shuffle), so a folder gets few files.  ``sort_within`` orders rows inside
    each output file (no shuffle), which tightens Parquet min/max statistics
    for later key and date filters.  With ``contract``, a NULL in a column the
    contract declares non-null (Spark does not enforce it) fails the write:
    files go to a sibling folder first and take the table's place only if the
    counts allow it, so a refused write leaves the old table as it was.  The
    old folder is moved aside and removed after the new one has its place;
    between the two renames the path is empty.  ``plans.versions`` has no such
    moment.
    """
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    counts = write_counted(df, staged, flags, partition_by, sort_within, contract)
    folder = Folder(df.sparkSession, staged)
    try:
        refuse_nulls(path, counts)
    except ValueError:
        folder.delete()
        raise
    folder.rename(path)
    return counts


class Folder:
    """A folder in whatever store Spark writes to (needs a session with a JVM, not Spark Connect)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.make = spark._jvm.org.apache.hadoop.fs.Path
        self.path = self.make(path)
        self.fs = self.path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def qualified(self) -> str:
        """The whole path, with its store (the catalog takes a relative one for a place in the warehouse)."""
        return self.fs.makeQualified(self.path).toString()

    def exists(self) -> bool:
        return self.fs.exists(self.path)

    def delete(self) -> None:
        self.fs.delete(self.path, True)

    def children(self) -> list[tuple[str, int]]:
        """(name, modification time in ms) of what the folder holds."""
        if not self.exists():
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in self.fs.listStatus(self.path)]

    def rename(self, path: str) -> None:
        """Takes the place of ``path``; what was there is removed last."""
        to, aside = self.make(path), None
        if self.fs.exists(to):
            aside = self.make(f"{path.rstrip('/')}.replaced-{uuid.uuid4().hex}")
            if not self.fs.rename(to, aside):
                raise OSError(f"could not move {to} aside")
        if not self.fs.rename(self.path, to):
            if aside is not None:
                self.fs.rename(aside, to)
            raise OSError(f"could not move {self.path} to {to}")
        if aside is not None:
            self.fs.delete(aside, True)


def with_year(df: DataFrame, key_col: str = "date_key") -> DataFrame:
    """Add ``year`` from a YYYYMMDD key, for ``partition_by=['year']``."""
    return df.withColumn("year", (F.col(key_col) / 10000).cast("int"))


def preview(df: DataFrame, n: int = 20) -> None:
    """Console preview of the first rows (a development aid)."""
    df.show(n)
