"""Near-duplicate documents by fast similarity sketching.

A document is its set of distinct five-word shingles.  Documents with equal
word sequences (by SHA-256) collapse to one representative.  Each set gets a sketch of T
coordinates: in round i every shingle is thrown into one hashed bin with a
value in [i, i + 1), and a bin keeps its smallest value.  One round fills
nearly every bin of a large set; small sets take more rounds, and the last T
rounds throw every shingle into one bin each, so that every coordinate is
filled.  Coordinates agree with probability equal to the Jaccard similarity,
with the concentration of independent samples.

Sketches are cut into bands.  Documents that share a band are candidates;
links are confirmed on the full sets of words:

* every member of a band bucket is compared with the bucket's smallest id;
* buckets whose other members are not yet in one component are compared
  member by member, in blocks of bounded size, and only a spanning forest
  of the confirmed links is written.

So no bucket is gathered in one task, no bucket is expanded into all its
pairs, and no link inside a bucket is lost to the connected components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import connected_components, map_batches, prepare, written

WORDS = 5
# Bands of ROWS coordinates: a pair of similarity 0.8 shares a band with
# probability 1 - (1 - 0.8^5)^28 = 0.99998, one of 0.3 with 0.07.
BANDS = 28
ROWS = 5
# Documents of one bucket, and shingle hashes (8 bytes each), that meet in one
# task: at most two blocks.
BLOCK = 192
BLOCK_SHINGLES = 1 << 20
# Distinct words whose hashes a worker remembers, from stage to stage.
_CACHE_WORDS = 1 << 18

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SEEDS = np.random.default_rng(20240501).integers(1, 2**63, size=4096, dtype=np.uint64) | np.uint64(1)
_WORD_HASH: dict[bytes, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; with fewer words
    the whole sequence is one shingle, without words there is none."""
    # bytes.lower() folds A-Z only, bytes.split() cuts at [\x20\x09-\x0D]+
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    if len(_WORD_HASH) > _CACHE_WORDS:
        _WORD_HASH.clear()
    known = _WORD_HASH
    for w in set(tokens):
        if w not in known:
            known[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    width = min(words, len(tokens))
    n = len(tokens) - width + 1
    total = np.full(n, np.uint64(width) * _SEEDS[0], np.uint64)
    for i in range(width):
        total += h[i:i + n] * _SEEDS[i + 1]
    return np.unique(_mix(total))


def sketch(sets: list[np.ndarray], size: int) -> np.ndarray:
    """One row of ``size`` coordinates per non-empty set, all sets at once."""
    out = np.full((len(sets), size), np.uint64(2**64 - 1), np.uint64)
    open_rows = [i for i, s in enumerate(sets) if len(s)]
    flat, top = out.reshape(-1), np.uint64(2**54 - 1)
    for rnd in range(2 * size):
        if not open_rows:
            break
        items = np.concatenate([sets[i] for i in open_rows])
        row = np.repeat(np.array(open_rows), [len(sets[i]) for i in open_rows])
        h = _mix(items + _SEEDS[64 + rnd])
        if rnd < size:
            bin_ = (_mix(h ^ _SEEDS[32]) % np.uint64(size)).astype(np.int64)
        else:
            bin_ = np.full(len(items), rnd - size)
        value = (np.uint64(rnd) << np.uint64(54)) | (h & top)
        np.minimum.at(flat, row * size + bin_, value)
        open_rows = [i for i in open_rows if out[i].max() == np.uint64(2**64 - 1)]
    return out


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    cut = sketches.reshape(len(sketches), bands, rows)
    total = np.broadcast_to(_SEEDS[2000:2000 + bands], cut.shape[:2]).copy()
    for i in range(rows):
        total = _mix(total + cut[:, :, i] * _SEEDS[2100 + i])
    return total.view(np.int64)


def shingle_set(text: str | None, words: int = WORDS) -> set[tuple[bytes, ...]]:
    """The set itself, on which links are confirmed."""
    tokens = (text or "").encode().lower().split()
    width = min(words, len(tokens))
    return {tuple(tokens[i:i + width]) for i in range(len(tokens) - width + 1)} if tokens else set()


def similar(a: set, b: set, percent: int) -> bool:
    if not a or not b or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def near_duplicates(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text",
                    words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per input row.

    Documents are linked if 100 * intersection >= ``percent`` * union of their
    shingle sets.  component_id is the smallest doc_id reachable by links,
    itself included; kept marks that document.  Null, empty and blank texts
    have the empty set and are linked with nothing.  A row with a null id has
    component_id null, is kept and is linked with nothing.  Rows that repeat
    an id are one node of the graph (each keeps its own n_shingles).  An empty
    table gives no rows; columns besides the two named are not read.
    """
    prepare(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_hashes(t, words) for t in b.column(1).to_pylist()]
            keys = band_keys(sketch(sets, bands * rows), bands, rows)
            n = np.array([len(s) for s in sets], np.int64)
            # equal normalised word sequences have equal sets, without trusting a 64-bit hash
            digest = [hashlib.sha256(b" ".join((t or "").encode().lower().split())).digest() if len(s) else None
                      for t, s in zip(b.column(1).to_pylist(), sets)]
            offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n), pa.array(digest, pa.binary()),
                 pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1)))],
                names=["doc_id", "n_shingles", "digest", "bands"])

    sketched = written(map_batches(source, sketches, "doc_id long, n_shingles long, digest binary, bands array<long>"),
                       "sketches")
    found = sketched.filter("doc_id is not null and digest is not null")
    # written, like the buckets below: a join straight to an aggregate could not split a hot key
    classes = written(found.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    member = found.select("doc_id", "digest").join(classes, "digest").select("doc_id", "rep")

    # band buckets of representatives, with the bucket's smallest id
    banded = (found.join(classes.select(F.col("rep").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi")
              .select("doc_id", F.explode("bands").alias("key")))
    shared = written(banded.groupBy("key").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last"),
                                               F.count("*").alias("n"))
                     .filter("head < last").select("key", "head", "n"), "shared-buckets")
    buckets = written(banded.join(shared, "key"), "buckets")
    edges = _confirmed(source, buckets, percent, words)
    # the copies of a class are linked, too: their ids may link classes where an id is repeated
    same = member.filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    parts = connected_components(edges.unionByName(same))
    out = sketched.select("doc_id", "n_shingles")
    if parts is None:
        out = out.withColumn("component_id", F.col("doc_id"))
    else:
        out = (out.join(parts.withColumnRenamed("id", "doc_id"), "doc_id", "left")
               .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _confirmed(source: DataFrame, buckets: DataFrame, percent: int, words: int) -> DataFrame:
    """Confirmed links (a, b) that connect whatever the links inside the
    buckets connect."""
    candidates = buckets.select("doc_id").distinct()
    texts = written(source.join(candidates, "doc_id", "left_semi"), "candidate-texts")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, set()
        for b in batches:
            a, c = [], []
            for d, t, head, ht in zip(*(col.to_pylist() for col in b.columns)):
                if last != (head, ht):  # rows of one head follow each other
                    last, last_set = (head, ht), shingle_set(ht, words)
                if similar(shingle_set(t, words), last_set, percent):
                    a.append(d)
                    c.append(head)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], names=["a", "b"])

    heads = texts.select(F.col("doc_id").alias("head"), F.col("text").alias("head_text"))
    pairs = (buckets.filter("doc_id <> head").select("doc_id", "head").distinct()
             .join(texts, "doc_id").join(heads, "head").select("doc_id", "text", "head", "head_text"))
    star = written(map_batches(pairs, verify, "a long, b long"), "star-links")

    # buckets whose other members are not in one component yet
    parts = connected_components(star)
    open_ = buckets.filter("n > 2 and doc_id <> head")
    if parts is None:
        open_ = open_.withColumn("component", F.col("doc_id"))
    else:
        open_ = (open_.join(parts.withColumnRenamed("id", "doc_id"), "doc_id", "left")
                 .withColumn("component", F.coalesce("component", "doc_id")))
    open_ = written(open_.select("key", "doc_id", "component", "n"), "open")
    apart = (open_.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                      F.count("*").alias("m"), F.sum(F.xxhash64("doc_id").cast("decimal(20,0)")).alias("f"))
             .filter("lo < hi"))
    once = written(apart.groupBy("m", "f").agg(F.min("key").alias("key")).select("key"), "open-buckets")  # same members: once
    return star.unionByName(_blocked(open_.select("key", "doc_id", "component").join(once, "key"), texts, percent, words))


def _blocked(members: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """Links between members of a bucket: every pair of blocks is one group.

    A group holds the sorted shingle hashes of its members, not their texts,
    and a block is cut by BLOCK members and BLOCK_SHINGLES hashes (expected),
    so it is bounded by bytes.  Its forest is found on the hashes; the links of
    the forest are then confirmed on the full sets of words.
    """
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingle_hashes(t, words) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(f) for f in found], pa.int64()), pa.array([f.tobytes() for f in found], pa.binary())],
                names=["doc_id", "n", "hashes"])

    open_texts = texts.join(members.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = written(map_batches(open_texts, hashes, "doc_id long, n long, hashes binary"), "shingle-hashes")
    sized = written(members.join(sets.select("doc_id", "n"), "doc_id"), "open-members")
    # sized by rows, too: a repeated id brings several texts
    blocks = written(sized.groupBy("key").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")), "open-sizes")
    mine = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("blocks")).cast("int")
    placed = (members.join(blocks, "key").withColumn("mine", mine)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", "doc_id", "component", F.least("mine", "other").alias("i"),
                      F.greatest("mine", "other").alias("j"), "mine"))

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        held = [np.frombuffer(h, np.uint64) for h in pdf["hashes"]]
        found = forest(held, pdf["component"].tolist(), pdf["mine"].tolist(), bool(pdf["i"].iloc[0] != pdf["j"].iloc[0]), percent)
        ids = pdf["doc_id"].tolist()
        return pd.DataFrame([(ids[x], ids[y]) for x, y in found], columns=["a", "b"]).astype("int64")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [similar(shingle_set(t, words), shingle_set(u, words), percent)
                  for t, u in zip(b.column("text").to_pylist(), b.column("other").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(ok)), b.column("b").filter(pa.array(ok))], names=["a", "b"])

    found = written(placed.join(sets, "doc_id").groupBy("key", "i", "j").applyInPandas(links, "a long, b long").distinct(), "block-links")
    pairs = (found.join(texts.select(F.col("doc_id").alias("a"), "text"), "a")
             .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("other")), "b"))
    return map_batches(pairs.select("a", "b", "text", "other"), confirm, "a long, b long")


def forest(sets: list[np.ndarray], part: list[int], block: list[int], between: bool, percent: int) -> list[tuple[int, int]]:
    """Links that connect whatever the links between sorted hash sets connect,
    beyond the components ``part`` that are known.  With ``between``, sets of
    one block are not compared.

    A set meets the known components in turn, and of each only as many members
    as it takes to find a link.  Before two sets are intersected, the prefix
    filter is: similar sets share a hash among the smallest (100 - percent) %
    of either.
    """
    members: dict[int, list[int]] = {}
    root = {c: c for c in part}
    out: list[tuple[int, int]] = []
    prefix = [s[:len(s) - -(-percent * len(s) // 100) + 1] for s in sets]

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    for x, s in enumerate(sets):
        own = find(part[x])
        for c in list(members):
            if c == own or find(c) != c:
                continue
            for y in members[c]:
                if between and block[x] == block[y] or not _alike(s, sets[y], prefix[x], prefix[y], percent):
                    continue
                out.append((x, y))
                kept = find(own)
                root[c] = kept
                members.setdefault(kept, []).extend(members.pop(c))
                own = kept
                break
        members.setdefault(find(own), []).append(x)
    return out


def _alike(a: np.ndarray, b: np.ndarray, a_prefix: np.ndarray, b_prefix: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if not small or 100 * small < percent * large:
        return False
    if not _shared(a_prefix, b_prefix):
        return False
    both = _shared(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted arrays without repeats."""
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())
