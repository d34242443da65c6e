"""Published versions as a source: one version, pinned for a session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marginflow.operators.aggregates import month_start
from marginflow.sources.sinks import new_version, publish_version, published_version, write_table


# Files that a month may have: as many tasks write.
MONTH_FILES = 128


def write_monthly(df: DataFrame, path: str, day: str, month: str = "report_month") -> None:
    """Store a fact table in a folder per month of ``day`` (first day of the
    month, as the partition column ``month``).  Every task writes the rows it has,
    without an exchange before, so a month with most of the rows is not one task,
    and a month has a bounded number of files."""
    rows = df.withColumn(month, month_start(day)).coalesce(MONTH_FILES)
    write_table(rows, path, partition_by=[month], mode="errorifexists", compression="zstd")


def publish(spark: SparkSession, out_dir: str, tables: dict[str, DataFrame], monthly: dict[str, str] | None = None) -> str:
    """Write ``tables`` as a new version under ``out_dir`` and publish it when
    all are complete; return the version's folder.  ``monthly``: table -> its
    day column, stored by month."""
    version = new_version(out_dir)
    for name, df in tables.items():
        if monthly and name in monthly:
            write_monthly(df, f"{version}/{name}", monthly[name])
        else:
            write_table(df, f"{version}/{name}", mode="errorifexists")
    publish_version(spark, out_dir, version)
    return version


class PinnedVersion:
    """Tables of the version that was published when the session first asked.

    All reads of a session see that version, however often a new one is
    published, until ``repin``; older versions stay on disk, so a running job
    never loses its files.
    """

    def __init__(self, spark: SparkSession, out_dir: str):
        self.spark, self.out_dir = spark, out_dir.rstrip("/")
        self._pins: dict[str, str] = spark.__dict__.setdefault("_marginflow_pins", {})
        if self.out_dir not in self._pins:
            self.repin()

    @property
    def version(self) -> str:
        return self._pins[self.out_dir]

    def repin(self) -> str:
        """Move to the version that is published now."""
        self._pins[self.out_dir] = published_version(self.spark, self.out_dir)
        return self.version

    def table(self, name: str) -> DataFrame:
        """A table of the pinned version; a table stored by month keeps its
        partition column, so filters and joins on it prune folders, also at
        run time."""
        return self.spark.read.parquet(f"{self.version}/{name}")

    def register_views(self, names: list[str], prefix: str = "") -> None:
        """Temp views of pinned tables, for SQL."""
        for name in names:
            self.table(name).createOrReplaceTempView(prefix + name)


def scratch_folder(root: str, name: str) -> str:
    """A folder of its own under ``root``."""
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
