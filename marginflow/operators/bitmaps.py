"""Mergeable exact distinct counts.

A set of positions (days, numbered keys) is kept as 64-bit words: position p is
bit p % 64 of word p / 64 of its group.  Words of a coarser group are the
bitwise OR of the finer groups' words, so distinct counts roll up over any
number of levels from one pass over the facts, each exact, none counted anew.

A word row costs some bytes where a ``bitmap_construct_agg`` bitmap costs 4,096
for every group: the groups here (client, platform, window, month) hold a few
days and campaigns each.  OR is an ordinary aggregate, partial before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 64


def word_of(position: Column) -> tuple[Column, Column]:
    """(slot, word): number of the word, as text, and the position's bit."""
    at = position.cast("bigint")
    bit = F.pmod(at, F.lit(WORD)).cast("int")
    return F.shiftright(at, 6).cast("string"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def text_word(key: Column) -> tuple[Column, Column]:
    """A key that has no position: a word of its own."""
    return F.concat(F.lit("="), key), F.when(key.isNotNull(), F.lit(1).cast("bigint"))


def bit_words(df: DataFrame, keys: list[str], sets: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(keys, kind, slot, word) of every group; ``sets``: kind -> (slot, word).
    NULL positions are in no set.  The facts are read once, whatever the number
    of sets."""
    entries = F.array(*[F.struct(F.lit(kind).alias("kind"), slot.alias("slot"), word.alias("word"))
                        for kind, (slot, word) in sets.items()])
    each = df.select(*keys, F.explode(entries).alias("e")).select(*keys, "e.*")
    return merge_words(each.where(F.col("word").isNotNull()), keys)


def merge_words(words: DataFrame, keys: list[str]) -> DataFrame:
    """Words of the coarser groups ``keys``."""
    return words.groupBy(*keys, "kind", "slot").agg(F.bit_or("word").alias("word"))


def count_words(words: DataFrame, keys: list[str], counts: dict[str, list[str]]) -> DataFrame:
    """(keys, counts) from merged words; ``counts``: column -> its kinds.
    Words of a group don't overlap, so their bits add up."""
    sums = [F.sum(F.when(F.col("kind").isin(*kinds), F.bit_count("word")).otherwise(F.lit(0))).cast("bigint").alias(c)
            for c, kinds in counts.items()]
    return words.groupBy(*keys).agg(*sums)


def numbered(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """(key, position) of the distinct non-NULL keys, numbered so that
    neighbours in ``order`` share words.  Numbers are dense within a range of
    the order and leave gaps between ranges; no task sees all keys.  Write the
    result before it is used: numbers may change when it is computed again."""
    distinct = df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.min(c).alias(f"_{i}") for i, c in enumerate(order)])
    by = [f"_{i}" for i in range(len(order))] + [key]
    return (distinct.repartitionByRange(*by).sortWithinPartitions(*by)
            .select(key, F.monotonically_increasing_id().alias("position")))
