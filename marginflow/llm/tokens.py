"""Token counts without token ids.

Pieces are counted once per distinct pre-token of the corpus; a document's
count is the sum over its pre-token frequencies.

1. Every task counts the pre-tokens of its documents; the partial counts are
   summed by pre-token, and the tokenizer counts the pieces of each distinct
   pre-token once.
2. Frequencies are joined to that vocabulary.  The most frequent pre-tokens,
   at most HEAD of them, are a broadcast of bounded size, which covers most of
   the text; only a document's rarer pre-tokens are shuffled to the rest.

A pre-token here is cut where the byte-level pre-tokenizer always cuts: before
a single space that is followed by a non-space.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import map_batches, prepare, written

# Most frequent pre-tokens sent to every task: at most HEAD rows of at most
# UNIT_CHARS code points each.
HEAD = 400_000
# Steps of the frequency scale per doubling, on which their cut is chosen.
_STEPS = 16
# Longer units hardly repeat; they are counted where they stand.
UNIT_CHARS = 64
# Distinct pre-tokens a task holds before it hands on partial counts.
FLUSH = 400_000
# Marks the first unit of a text, which has no space before it.
_FIRST = "\x00"

_TOKENIZERS: dict[str, tuple] = {}


def tokenizer(path: str):
    """The library's tokenizer and its special strings, once per process."""
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_padding()
        t.no_truncation()
        special = tuple(a.content for a in t.get_added_tokens_decoder().values())
        _TOKENIZERS[path] = (t, special)
    return _TOKENIZERS[path]


def units(text: str, special: tuple[str, ...]) -> tuple[list[str], list[str]]:
    """(vocabulary keys, strings to count in place) of one text.

    A key stands for its string with a space before it, or for the rest of
    it after ``_FIRST``.  Texts with a special string or a NUL are counted
    whole: there the cuts could differ from the library's.
    """
    if _FIRST in text or any(s in text for s in special):
        return [], [text]
    parts = text.split(" ")
    if "" in parts or any(p[0].isspace() or p[0] == "\u180e" for p in parts):
        merged = [parts[0]]
        for p in parts[1:]:
            if p and not (p[0].isspace() or p[0] == "\u180e"):
                merged.append(p)
            else:  # this space is followed by space or the end: no cut
                merged[-1] += " " + p
        parts = merged
    first, rest, whole = parts[0], parts[1:], []
    if max(map(len, parts)) > UNIT_CHARS:
        whole = [" " + p for p in rest if len(p) > UNIT_CHARS]
        rest = [p for p in rest if len(p) <= UNIT_CHARS]
        if len(first) > UNIT_CHARS:
            whole.append(first)
            first = ""
    if first:
        rest.append(_FIRST + first)
    return rest, whole


def n_pieces(strings: list[str], path: str) -> list[int]:
    t, _ = tokenizer(path)
    return [len(e.ids) for e in t.encode_batch(strings, add_special_tokens=False)]


def count_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                 head: int = HEAD) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per input row, over whole texts.

    A null text counts as empty: 0 bytes, 0 tokens.  Every row is counted by
    itself, repeated ids and null ids included; an empty table gives no rows.
    Columns besides the two named are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))

    def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = tokenizer(path)[1]
        seen: Counter[str] = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            keys = list(seen)
            for i in range(0, len(keys), 50_000):
                part = keys[i:i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()),
                                                  pa.array([seen[k] for k in part], pa.int64())], names=["unit", "n"])
            seen.clear()

        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update(units(t, special)[0])
            if len(seen) >= FLUSH:
                yield from flush()
        yield from flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            strings = [u[1:] if u[0] == _FIRST else " " + u for u in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n_pieces(strings, path), pa.int32())],
                                             names=["unit", "n", "pieces"])

    distinct = (map_batches(rows.select("text"), vocabulary, "unit string, n long")
                .groupBy("unit").agg(F.sum("n").alias("n")))
    vocab = written(map_batches(distinct, count, "unit string, n long, pieces int"), "vocabulary")
    step = F.floor(F.log2("n") * _STEPS)
    sizes = {r["step"]: r["size"] for r in vocab.groupBy(step.alias("step")).agg(F.count("*").alias("size")).collect()}
    cut, taken = None, 0
    for k in sorted(sizes, reverse=True):
        taken += sizes[k]
        if taken > head:
            break
        cut = k
    top = vocab.filter(step >= cut if cut is not None else F.lit(False)).select("unit", "pieces").toArrow()
    shared = spark.sparkContext.broadcast(dict(zip(top["unit"].to_pylist(), top["pieces"].to_pylist())))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special, pieces_of = tokenizer(path)[1], shared.value.get
        for b in batches:
            rid, ids, n_bytes, n_tokens, unit, n = [], [], [], [], [], []
            for r, d, t in zip(*(c.to_pylist() for c in b.columns)):
                keys, whole = units(t, special)
                found = list(map(pieces_of, keys))
                rare = Counter([k for k, f in zip(keys, found) if f is None]) if None in found else ()
                rid.append(r)
                ids.append(d)
                n_bytes.append(len(t.encode()))
                n_tokens.append(sum(filter(None, found)) + (sum(n_pieces(whole, path)) if whole else 0))
                unit.append(f"{_FIRST}{_FIRST}{r}")  # in no vocabulary; spreads these rows
                n.append(None)
                if rare:
                    rid += [r] * len(rare)
                    none = [None] * len(rare)
                    ids += none
                    n_bytes += none
                    n_tokens += none
                    unit += rare.keys()
                    n += rare.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid, pa.int64()), pa.array(ids, pa.int64()), pa.array(n_bytes, pa.int64()),
                 pa.array(n_tokens, pa.int64()), pa.array(unit, pa.string()), pa.array(n, pa.int32())],
                names=["rid", "doc_id", "n_bytes", "n_tokens", "unit", "n"])

    parts = map_batches(rows, documents, "rid long, doc_id long, n_bytes long, n_tokens long, unit string, n int")
    joined = parts.join(vocab.select("unit", "pieces"), "unit", "left")
    return (joined.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"),
        F.sum(F.coalesce(F.col("n_tokens"), F.col("n") * F.col("pieces"))).alias("n_tokens"))
        .select("doc_id", "n_bytes", "n_tokens"))
