"""Best-fit packing of tokenised documents, planned on the length histogram.

1. Documents become pieces of at most ``limit`` tokens (a distributed pass).
2. The histogram of piece lengths, at most ``limit`` counts, is packed on the
   driver by best-fit decreasing over counts: runs of equal sequences are
   treated at once, so the work depends on ``limit`` and not on the corpus.
   A placement says that the pieces of ranks [rank, rank + n) among those of
   one length go to the sequences [sequence, sequence + n) at one offset.
3. Every piece gets its rank within its length (salted, so one frequent
   length is spread over many tasks) and takes the slot planned for it.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginflow.llm.common import map_batches, prepare, written
from marginflow.llm.tokens import tokenizer

LIMIT = 4096
END_ID = 1
# Distinct words and parts of words whose ids a worker remembers.  Workers live
# on from stage to stage, so what they remember stays small.
_CACHE_WORDS = 1 << 18
_CACHE_PARTS = 1 << 18
_WORDS: dict[str, dict[bytes, bytes]] = {}
_PARTS: dict[str, dict[bytes, bytes]] = {}
# Words that fall into letters and others wherever the pre-tokenizer looks:
# ASCII without apostrophes, and precomposed Latin letters (no multiplication
# or division sign, no special strings).  U+0130 is none of them: its lower
# case ends in a combining mark, which joins the punctuation after it.
_PLAIN = re.compile(rb"(?:[\x00-\x26\x28-\x7f]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|[\xc5-\xc9][\x80-\xbf])*")
_RUNS = re.compile(rb"[a-z\x80-\xff]+|[^a-z\x80-\xff]+")


def _parts_of(word: bytes) -> list[bytes]:
    """Pieces of a word between which the pre-tokenizer always cuts."""
    if b"<|" in word or not _PLAIN.fullmatch(word):
        return [word]
    return _RUNS.findall(word.lower())


def _encode_parts(parts: list[bytes], path: str) -> dict[bytes, bytes]:
    t = tokenizer(path)[0]
    model, out, rest = t.model, {}, []
    for p in parts:
        if p.isalpha() and p.islower():  # ASCII letters: one pre-token, as it stands
            ids = [x.id for x in model.tokenize(p.decode())]
            out[p] = struct.pack(f"<{len(ids)}I", *ids)
        else:
            rest.append(p)
    if rest:
        e = t.encode([p.decode() for p in rest], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(e.ids, "<u4")
        ends = np.cumsum(np.bincount(np.array(e.word_ids, np.int64), minlength=len(rest))).tolist()
        for p, lo, hi in zip(rest, [0, *ends], ends):
            out[p] = ids[lo:hi].tobytes()
    return out


def word_ids(texts: pa.StringArray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts side by side, and the place where each text ends.

    The tokenizer drops white space and never joins across it, so every word
    between [\\x20\\x09-\\x0D] is put together once from the ids of its
    parts, which the library encodes once, and remembered.  Texts are split and
    their words numbered by Arrow, so that Python sees each distinct word of a
    batch once.
    """
    words, parts = _WORDS.setdefault(path, {}), _PARTS.setdefault(path, {})
    if len(words) > _CACHE_WORDS:
        words.clear()
    if len(parts) > _CACHE_PARTS:
        parts.clear()
    split = pc.ascii_split_whitespace(texts)
    numbered = split.flatten().dictionary_encode()
    distinct = numbered.dictionary.cast(pa.binary()).to_pylist()
    missing = [w for w in distinct if w not in words]
    letters = {w: w.lower() for w in missing if w.isalpha()}  # ASCII letters only
    others = {w: _parts_of(w) for w in missing if w not in letters}
    new = set(letters.values()).union(*others.values()).difference(parts)
    parts.update(_encode_parts(list(new), path))
    for w, p in letters.items():
        words[w] = parts[p]
    for w, own in others.items():
        words[w] = b"".join([parts[p] for p in own])

    found = list(map(words.__getitem__, distinct))
    values = np.frombuffer(b"".join(found), "<u4")
    length = np.fromiter(map(len, found), np.int64, len(found)) // 4
    first = np.cumsum(length) - length
    index = numbered.indices.to_numpy()
    n = length[index]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    ids = values[np.arange(total) + np.repeat(first[index] - (ends - n), n)]
    words_before = split.offsets.to_numpy().astype(np.int64)
    return ids, np.concatenate([[0], ends])[words_before[1:] - words_before[0]]


def plan_slots(histogram: dict[int, int], limit: int = LIMIT) -> tuple[np.ndarray, int]:
    """Placements (length, rank, n, sequence, offset) and the number of
    sequences, by best-fit decreasing over counts."""
    placements: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs (first sequence, sequences)
    free: list[int] = []                         # keys of room, ascending
    sequences = 0

    def add(tokens: int, first: int, n: int) -> None:
        if n and tokens:
            if tokens not in room:
                room[tokens] = []
                bisect.insort(free, tokens)
            room[tokens].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(free, length)
            if at < len(free):
                tokens = free[at]
                first, n = room[tokens].pop()
                if not room[tokens]:
                    del room[tokens]
                    free.pop(at)
            else:
                tokens, each = limit, limit // length
                first, n = sequences, -(-left // each)
                sequences += n
            # a sequence that took one piece is the best fit for the next
            each = tokens // length
            full = min(n, left // each)
            rest = min(left - full * each, each) if full < n else 0
            for run, items, start in ((full, each, first), (1 if rest else 0, rest, first + full)):
                for j in range(items if run else 0):
                    placements.append((length, rank, run, start, limit - tokens + j * length))
                    rank += run
                add(tokens - items * length, start, run)
            used = full + (1 if rest else 0)
            add(tokens, first + used, n - used)
            left = histogram[length] - rank
    return np.array(placements, np.int64).reshape(-1, 5), sequences


def pack(docs: DataFrame, path: str, limit: int = LIMIT, end_id: int = END_ID, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece.

    A null text counts as empty: its only token is ``end_id``.  Only documents
    of more than ``limit`` tokens are cut.  Every row is a document of its
    own, repeated ids and null ids included; an empty table gives no rows.
    Columns besides the two named are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    end = struct.pack("<I", end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, piece, start, length, crc = [], [], [], [], []
            flat, ends = word_ids(b.column(1), path)
            for d, lo, hi in zip(b.column(0).to_pylist(), [0, *ends.tolist()], ends.tolist()):
                found = flat[lo:hi].tobytes() + end
                for k, at in enumerate(range(0, len(found), 4 * limit)):
                    part = found[at:at + 4 * limit]
                    ids.append(d)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    pieces = written(map_batches(source, cut, "doc_id long, piece int, start long, length long, ids_crc32 long")
                     .withColumn("row", F.monotonically_increasing_id()), "pieces")

    # ranks within a length: salted groups, shifted by the counts of the salts
    # before.  Salted by the written row, so that equal rows spread, too
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
    counts = written(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = counts.select("length", "salt", (F.sum("n").over(
        Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("row")
    ranked = (salted.withColumn("place", F.row_number().over(within) - 1).join(before, ["length", "salt"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank")))

    plan, _ = plan_slots(histogram, limit)
    order = np.lexsort((plan[:, 1], plan[:, 0]))
    plan = plan[order]
    shared = spark.sparkContext.broadcast(plan)  # its size depends on limit alone

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        starts = (slots[:, 0] << 48) | slots[:, 1]
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = np.searchsorted(starts, (length << 48) | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(slots[at, 3] + rank - slots[at, 1]), pa.array(slots[at, 4])],
                names=[*b.schema.names[:5], "sequence_id", "offset"])

    return map_batches(ranked, place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                      "sequence_id long, offset long")
