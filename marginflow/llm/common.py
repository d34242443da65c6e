"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import marginflow
from marginflow.session import ensure_checkpoint_dir

# Rows and bytes of one Arrow batch handed to Python: a worker holds one batch
# at a time.
BATCH_ROWS = 1024
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Settings of the operators' Python stages (performance only), and this
    package for the executors' Python workers."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def _ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per Spark context, so
    that workers find it wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_marginflow_shipped", False):
        return
    root = Path(marginflow.__file__).parent
    if not root.is_dir():  # imported from an archive: the workers have it, too
        return
    archive = Path(tempfile.mkdtemp(prefix="marginflow-")) / "marginflow.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._marginflow_shipped = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    The lineage ends at files that every executor sees, so a lost executor
    never sends the job back further than this table.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 2 modulo 4 (a null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def slice_of(text: Column, most: int) -> Column:
    """The text, or ``most`` code points of it from a place that its hash picks."""
    spare = F.greatest(F.lit(1), F.length(text) - F.lit(most - 1))
    return F.substring(text, (F.pmod(F.xxhash64(text, F.lit(17)), spare) + 1).cast("int"), F.lit(most))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def batch_of(columns: dict[str, pa.Array | list], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[k], type=t) if not isinstance(columns[k], pa.Array) else columns[k]
         for k, t in types.items()], names=list(types))


def task_folder() -> str:
    """Scratch folder of the running task's own machine (for spills that the
    same task reads back and deletes)."""
    return os.environ.get("TMPDIR", "/tmp")


def connected_components(edges: DataFrame) -> DataFrame | None:
    """Components of the undirected graph ``edges(a long, b long)``.

    Returns (id, component): every node of an edge, with the smallest id it
    can reach.  None if there is no edge.

    Each round points every node at its smallest neighbour (by id in the
    first round, by a seeded hash later, so long chains shrink by a constant
    factor), contracts the edges and drops loops.  A round is aggregates and
    joins only; a hub's edges are pre-aggregated before they are shuffled.
    Every round is written to the shared folder.
    """
    mapping: DataFrame | None = None
    seed = 0
    current = written(_normal(edges), "edges")
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = (lambda c: c) if seed == 0 else (lambda c, s=seed: F.xxhash64(c, F.lit(s)))
        best = both.groupBy("a").agg(F.min(F.struct(rank(F.col("b")).alias("r"), F.col("b").alias("id"))).alias("m"))
        own = F.struct(rank(F.col("a")).alias("r"), F.col("a").alias("id"))
        parent = written(best.select("a", F.least(F.col("m"), own)["id"].alias("p")), "parents")
        if mapping is None:
            mapping = parent.select(F.col("a").alias("id"), F.col("p").alias("root"))
        else:
            step = parent.select(F.col("a").alias("root"), "p")
            mapping = written(mapping.join(step, "root", "left")
                              .select("id", F.coalesce("p", "root").alias("root")), "roots")
        moved = (current.join(parent, "a").select(F.col("p").alias("x"), "b")
                 .join(parent.select(F.col("a").alias("b"), F.col("p").alias("y")), "b")
                 .select(F.col("x").alias("a"), F.col("y").alias("b")))
        current = written(_normal(moved), "edges")
        seed += 1
    if mapping is None:
        return None
    smallest = mapping.groupBy("root").agg(F.min("id").alias("component"))
    return mapping.join(smallest, "root").select("id", "component")


def _normal(edges: DataFrame) -> DataFrame:
    return (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .filter("a <> b").distinct())
