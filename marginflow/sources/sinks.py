"""Sinks: table (parquet), versioned publication, view, and lineage-cutting
materialisation."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.session import ensure_checkpoint_dir

POINTER = "CURRENT"


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", compression: str = "snappy") -> None:
    """Materialise a relation as a parquet table (full rebuild by default).

    Every task writes its own files, so a lost executor only re-runs its
    tasks.  Overwriting deletes the old files before the new ones are there;
    readers that must not see the gap read a published version instead.
    """
    writer = df.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with header, RFC-4180 quoting and UTF-8; NULL is an empty cell."""
    (df.write.option("header", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
     .option("emptyValue", "").option("nullValue", "").csv(path))


def in_order(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` dealt out so that its written files, in name order, hold the rows
    in the order of ``order`` (ascending, NULLS LAST).

    Rows are dealt out by ranges of the order and sorted within the task, so
    nothing is sorted in one place; file statistics of the first column don't
    overlap beyond a shared border, and a filter on it skips files.
    """
    by = [F.asc_nulls_last(c) for c in order]
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> None:
    """Materialise a relation at ``path`` as the catalogue table ``table``, in
    ``buckets`` buckets of ``keys``, each sorted by them.  Joins and groupings by
    the keys read it without an exchange.  ``df`` should come dealt out by
    ``repartition(buckets, *keys)``: a bucket is then one file."""
    (df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
     .format("parquet").saveAsTable(table))


# Files that one dealing may leave.  Writing a file (and opening it again) takes as long as thousands
# of rows do, and buckets x writers grows with the square of the tables.
MOST_FILES = 1 << 13
# Buckets that a task takes on where rows are stored beyond that.
BUCKETS_A_WRITER = 12


@dataclass(frozen=True)
class Dealing:
    """How facts are dealt out: in ``buckets``, in files by up to ``writers`` tasks."""
    buckets: int
    writers: int
    keep: bool = False      # always stored
    placed: bool = False    # comes dealt out by the key into as many parts
    # keys by which the rows of a bucket are put in order: what groups by them is quicker for it
    ordered: tuple[str, ...] = ("client_id",)

    @property
    def fits(self) -> bool:
        """The files of all writers are few."""
        return self.buckets * self.writers <= MOST_FILES


def deal(spark: SparkSession, df: DataFrame, key: str, how: Dealing, name: str) -> DataFrame:
    """Write ``df`` in buckets of ``key`` under the shared checkpoint
    folder and read it back: joins and groupings by the key need no exchange
    of it.

    Every task writes the rows it has, without an exchange before: one file per
    bucket it meets, by no more than ``how.writers`` tasks.  Stored in columns a row takes a fraction of what it takes
    in a shuffle, where rows travel whole.

    Where that makes more than ``MOST_FILES`` files, rows that need not be kept are not
    stored: one exchange by the key takes them to as many parts, which joins and groupings find
    in the same way, and what is kept is written by fewer tasks.  Rows that are ``placed`` need
    neither an exchange nor more than a file per bucket.
    """
    if not (how.fits or how.keep):
        return df if how.placed else df.repartition(how.buckets, key)
    uid = uuid.uuid4().hex[:12]
    table = f"dealt_{name.replace('-', '_')}_{uid}"
    many = max(how.buckets // BUCKETS_A_WRITER, spark.sparkContext.defaultParallelism)
    rows = df if how.placed else df.coalesce(how.writers if how.fits else min(many, how.writers))
    writer = rows.write.bucketBy(how.buckets, key)
    if key in how.ordered:
        writer = writer.sortBy(key)
    (writer.option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uid}")
     .option("compression", "zstd").format("parquet").saveAsTable(table))
    return spark.table(table)


def new_version(out_dir: str) -> str:
    """Folder of a build that is not published yet."""
    return f"{out_dir.rstrip('/')}/versions/{uuid.uuid4().hex}"


def publish_version(spark: SparkSession, out_dir: str, version: str) -> None:
    """Make ``version`` the one that readers of ``out_dir`` find.

    The name of the version is written to a file of its own, which then
    replaces the pointer file in one rename.  Older versions stay.
    """
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(f"{out_dir.rstrip('/')}/{POINTER}")
    fresh = jvm.org.apache.hadoop.fs.Path(f"{out_dir.rstrip('/')}/.{POINTER}-{uuid.uuid4().hex}")
    stream = target.getFileSystem(conf).create(fresh)
    stream.write(version.rsplit("/", 1)[-1].encode())
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fresh, target, overwrite)


def published_version(spark: SparkSession, out_dir: str) -> str:
    """Folder of the published version."""
    out = out_dir.rstrip("/")
    name = spark.read.text(f"{out}/{POINTER}").first()[0]
    return f"{out}/versions/{name}"


def register_view(df: DataFrame, name: str) -> None:
    """A lazy, named relation (recomputed on each use)."""
    df.createOrReplaceTempView(name)


def materialize(spark: SparkSession, df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Downstream plans then start from the written files: their lineage is cut
    at this point, so recomputation after an executor loss never reaches
    back to the raw inputs.
    """
    base = (root or ensure_checkpoint_dir(spark)).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
    write_table(df, path)
    return spark.read.schema(df.schema).parquet(path)
