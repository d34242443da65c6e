"""Mixing sources to target weights (DataFrame functions only).

Capped water-filling: sources share all words by weight; a source that would
be repeated more than ``max_epochs`` times is clamped there and the excess
goes to the others by weight, until none is above its cap.  A source is then
taken whole as often as its target allows, and the rest of the target is the
beginning of the source in a seeded order of its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginflow.llm.common import written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 7
# Hash buckets of the seeded order: only the bucket in which a source's rest
# ends is put in order, about 1/4096 of the source's ids.  Rows that share id
# and size count as one there, and those at the end are numbered task by task.
_BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def water_fill(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    One row per source; sources rank by code point, null last, and take the
    weights in turn.  In the order of cap / weight the clamped sources come
    first, so one running sum finds the level of the rest.
    """
    ranked = Window.orderBy(F.col("source").isNull(), "source")  # one row per source
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(ranked) - 1) % len(weights) + 1).cast("int"))
    w = sizes.select("source", "source_size", weight.cast("long").alias("weight"), F.row_number().over(ranked).alias("rank"))
    w = w.withColumn("cap", F.col("source_size") * max_epochs)
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    done = filling.rowsBetween(Window.unboundedPreceding, -1)
    every = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = (w.withColumn("words_left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(done), F.lit(0)))
         .withColumn("weight_left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(done), F.lit(0))))
    clamped = F.col("weight") * F.col("words_left") > F.col("cap") * F.col("weight_left")
    level = F.max(F.when(~clamped, F.col("words_left").cast("double") / F.col("weight_left"))).over(every)
    return w.select("source", "source_size",
                    F.when(clamped, F.col("cap").cast("double")).otherwise(F.col("weight") * level).alias("target"))


def mix(docs: DataFrame, payload: Column, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        narrow: bool = True) -> DataFrame:
    """(payload, size, source_size, target, taken, repeats) per input row.

    ``payload`` is any column of ``docs``.  size is the number of words (null
    text: 0).  ``taken`` counts the words that the mix takes of the row,
    repeats counted; a source's taken words add up to its rounded target.
    Every row is taken wholly as often as its source is; the row in which the
    rest ends is taken in part.  ``repeats`` is taken in whole rows (that last
    row counts if half of it or more is taken); rows without words follow
    their source's whole repetitions.  Null ids and sources are values of
    their own, repeated rows are rows of their own, and an empty table gives
    no rows.  ``narrow`` writes ids and sizes once instead of reading the
    texts again (for a small payload).
    """
    seeded = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))
    rows = docs.select(payload.alias("payload"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                       seeded.alias("u"))
    if narrow:
        rows = written(rows, "mix-sizes")
    bucket = F.substring("u", 1, _BUCKET_DIGITS)
    rows = rows.withColumn("bucket", bucket)
    parts = written(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    targets = water_fill(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    want = F.round("target").cast("long")
    targets = (targets.withColumn("whole", F.when(F.col("source_size") > 0, F.expr("cast(round(target) as long) div source_size"))
                                  .otherwise(F.lit(max_epochs)))
               .withColumn("rest", want - F.col("whole") * F.col("source_size")))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ends = (parts.withColumn("upto", F.sum("words").over(running)).alias("p")
            .join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")))
            .filter("upto > rest").groupBy(F.col("t.source").alias("s"))
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("end")))
    plan = written(targets.join(ends, F.col("source").eqNullSafe(F.col("s")), "left")
                   .select(F.col("source").alias("s"), "source_size", "target", "whole", "rest",
                           F.col("end.bucket").alias("end"), F.col("end.before").alias("before")), "mix-plan")
    placed = rows.join(plan, F.col("source").eqNullSafe(F.col("s")))
    clear = placed.filter("end is null or bucket <> end").withColumn(
        "extra", F.when(F.col("bucket") < F.col("end"), F.col("size")).otherwise(F.lit(0)).cast("long"))
    # inside the last bucket: rows of one id and size are equal to the order
    same = written(placed.filter("bucket = end").groupBy("s", "rest", "before", "u", "size").agg(F.count("*").alias("n")),
                   "mix-same")
    order = Window.partitionBy("s").orderBy("u", "size").rowsBetween(Window.unboundedPreceding, 0)
    turn = written(same.withColumn("upto", F.col("before") + F.sum(F.col("n") * F.col("size")).over(order))
                   .filter("upto > rest").groupBy("s")
                   .agg(F.min(F.struct("u", "size", (F.col("upto") - F.col("n") * F.col("size")).alias("ahead"))).alias("at"))
                   .select(F.col("s").alias("turn_source"), F.col("at.u").alias("turn_u"),
                           F.col("at.size").alias("turn_size"), F.col("at.ahead").alias("ahead")), "mix-turn")
    ending = placed.filter("bucket = end").join(turn, F.col("s").eqNullSafe(F.col("turn_source")))
    off = ending.filter("u <> turn_u or size <> turn_size").withColumn(
        "extra", F.when(F.struct("u", "size") < F.struct("turn_u", "turn_size"), F.col("size")).otherwise(F.lit(0)).cast("long"))
    # the rows at the turn, each with the task that wrote it
    at = written(ending.filter("u = turn_u and size = turn_size").withColumn("task", F.spark_partition_id()), "mix-last")
    earlier = Window.partitionBy("task_source").orderBy("task_no").rowsBetween(Window.unboundedPreceding, 0)
    tasks = written(at.groupBy(F.col("s").alias("task_source"), F.col("task").alias("task_no")).agg(F.count("*").alias("n"))
                    .withColumn("earlier", F.sum("n").over(earlier) - F.col("n")), "mix-tasks")
    place = F.row_number().over(Window.partitionBy("s", "task").orderBy(F.xxhash64("payload"))) - 1
    left = F.col("rest") - F.col("ahead") - (F.col("earlier") + F.col("place")) * F.col("size")
    last = (at.withColumn("place", place)
            .join(tasks, F.col("s").eqNullSafe(F.col("task_source")) & (F.col("task") == F.col("task_no")))
            .withColumn("extra", F.least(F.col("size"), F.greatest(left, F.lit(0))).cast("long")))
    columns = ["payload", "size", "source_size", "target", "whole", "extra"]
    clear, last = clear.select(*columns), off.select(*columns).unionByName(last.select(*columns))
    return (clear.unionByName(last)
            .select("payload", "size", "source_size", "target",
                    (F.col("whole") * F.col("size") + F.col("extra")).alias("taken"),
                    (F.col("whole") + F.when((F.col("extra") > 0) & (2 * F.col("extra") >= F.col("size")), 1).otherwise(0))
                    .cast("int").alias("repeats")))
