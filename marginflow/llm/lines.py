"""Corpus-wide line deduplication.

Lines are normalised, hashed and exploded; a hash found in several documents
is kept only in the smallest document that holds it, and the documents are
put together again from the lines that stay, in their order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import map_batches, prepare, written

MIN_CHARS = 10
_BLANK = b" \t\n\x0b\x0c\r"


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """128-bit key per line; None for a line whose key has too few code points."""
    keys: list[bytes | None] = []
    # bytes.lower() folds A-Z only
    for line in (text or "").encode().lower().split(b"\n"):
        k = line.strip(_BLANK)
        if len(k) < min_chars or (len(k) < 4 * min_chars and len(k.decode()) < min_chars):
            keys.append(None)
        else:
            keys.append(xxhash.xxh3_128_digest(k))
    return keys


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                        min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) per input row: whole texts without
    the lines that a smaller doc_id holds too.

    Null or empty texts are one empty line and stay empty.  A row with a null
    id neither loses lines nor makes others lose them.  Rows that repeat an id
    are one document: they keep each other's lines.  An empty table gives no
    rows; other columns are not read.

    Hot lines are counted by a pre-aggregated minimum and maximum of the id;
    the join back is a plain sort-merge join, which Spark splits where a line
    is very common.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = [], []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = {k for k in line_keys(t, min_chars) if k is not None}
                ids += [d] * len(own)
                out += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())],
                                             names=["doc_id", "key"])

    lines = written(map_batches(rows.filter("doc_id is not null and text is not null"), keys,
                                "doc_id long, key binary"), "lines")
    # written: joined straight to the aggregate, a common line would stay in its one partition
    repeated = written(lines.groupBy("key").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"))
                       .filter("keeper < last").select("key", "keeper"), "repeated-lines")
    losses = (lines.join(repeated, "key").filter("doc_id <> keeper").select("doc_id", "key")
              .groupBy("doc_id").agg(F.collect_set("key").alias("lost")))

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, n_lines, n_dropped = [], [], []
            for t, lost in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                source = (t or "").split("\n")
                stay = source
                if lost:
                    lost = set(lost)
                    stay = [x for x, k in zip(source, line_keys(t, min_chars)) if k not in lost]
                kept.append("\n".join(stay))
                n_lines.append(len(source))
                n_dropped.append(len(source) - len(stay))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()),
                 pa.array(n_dropped, pa.int64())], names=["doc_id", "text", "n_lines", "n_dropped"])

    return map_batches(rows.join(losses, "doc_id", "left").select("doc_id", "text", "lost"), rebuild,
                       "doc_id long, text string, n_lines long, n_dropped long")
