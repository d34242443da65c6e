"""Quality scores from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document.
Expectation-maximisation over the counts of their vote patterns (a table of
at most 3 ** labellers rows, over all documents) estimates how accurate each
labeller is and the posterior of every pattern.  Posterior labels of a
bounded sample train a hashed linear scorer, which scores every document.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import map_batches, prepare, slice_of

# Bounds of the training sample: distinct texts and code points (expected), and
# code points of one text (a longer one is represented by a slice).
SAMPLE_DOCS = 6_000
SAMPLE_CHARS = 24_000_000
SLICE_CHARS = 131_072
BITS = 14
EM_STEPS = 100
STEPS = 200
THRESHOLD = 0.5
_CACHE_CHUNKS = 1 << 19

_LETTERS = bytes(c for c in range(256) if 97 <= c <= 122 or 65 <= c <= 90 or c >= 128)
_UPPER = bytes(range(65, 91))
_SYMBOLS = b"#$%&*@^~_=<>|\\{}[]"


def statistics(data: bytes, chunks: list[bytes]) -> dict[str, float]:
    n, size = len(chunks), max(1, len(data))
    letters = len(data) - len(data.translate(None, _LETTERS))
    upper = len(data) - len(data.translate(None, _UPPER))
    counts = Counter(chunks)
    stops = data.count(b".") + data.count(b"!") + data.count(b"?")
    return {
        "n": n,
        "letters": letters / size,
        "upper": upper / max(1, letters),
        "symbols": (len(data) - len(data.translate(None, _SYMBOLS))) / size,
        "distinct": len(counts) / max(1, n),
        "top": max(counts.values(), default=0) / max(1, n),
        "short": sum(k for c, k in counts.items() if len(c) <= 3 and c.isalpha()) / max(1, n),
        "sentence": n / max(1, stops),
        "width": letters / max(1, n),
    }


def _vote(good: bool, bad: bool) -> int:
    return 2 if good else 0 if bad else 1


# Each labeller votes 2 (good), 0 (bad) or 1 (abstains).
LABELLERS = (
    lambda s: _vote(s["symbols"] < 0.01, s["symbols"] > 0.05),
    lambda s: _vote(s["letters"] > 0.76, s["letters"] < 0.68),
    lambda s: _vote(s["upper"] < 0.15, s["upper"] > 0.4),
    lambda s: 1 if s["n"] < 20 else _vote(s["distinct"] > 0.4, s["distinct"] < 0.2),
    lambda s: 1 if s["n"] < 20 else _vote(s["top"] < 0.12, s["top"] > 0.25),
    lambda s: 1 if s["n"] < 20 else _vote(s["short"] > 0.15, s["short"] < 0.08),
    lambda s: _vote(3 <= s["sentence"] <= 40, s["sentence"] < 1.5 or s["sentence"] > 80),
    lambda s: _vote(s["n"] >= 40, s["n"] < 4),
    lambda s: _vote(3.0 <= s["width"] <= 9.0, s["width"] < 2 or s["width"] > 14),
)


def pattern(text: str | None) -> int:
    """Votes of all labellers as one number in base 3."""
    data = (text or "").encode()
    s = statistics(data, data.split())
    out = 0
    for labeller in LABELLERS:
        out = 3 * out + labeller(s)
    return out


def estimate(patterns: dict[int, int]) -> dict:
    """EM over pattern counts: prior, vote probabilities by class and
    labeller, and the posterior of good for every pattern."""
    k = len(LABELLERS)
    keys = np.array(sorted(patterns), np.int64)
    n = np.array([patterns[p] for p in keys.tolist()], np.float64)
    votes = np.stack([(keys // 3 ** (k - 1 - j)) % 3 for j in range(k)], axis=1)
    # start from the votes' balance: it fixes which class is called good
    good = 1 / (1 + np.exp(-(1.5 * (votes - 1).sum(axis=1) - 1.5 * (k // 3))))
    prior, table = 0.5, np.zeros((2, k, 3))
    for _ in range(EM_STEPS):
        weight = np.stack([n * (1 - good), n * good])
        prior = (weight[1].sum() + 1) / (n.sum() + 2)
        for j in range(k):
            for v in range(3):
                table[:, j, v] = weight[:, votes[:, j] == v].sum(axis=1) + 1.0
        table /= table.sum(axis=2, keepdims=True)
        log = np.log(table)
        score = math.log(prior / (1 - prior)) + sum(log[1, j, votes[:, j]] - log[0, j, votes[:, j]] for j in range(k))
        good = 1 / (1 + np.exp(-np.clip(score, -50, 50)))
    return {"prior": prior, "votes": table, "posterior": dict(zip(keys.tolist(), good.tolist()))}


_RUNS = re.compile(rb"(.)\1+")
_SHAPE = bytes(97 if (97 <= c <= 122 or c >= 128) else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c
               for c in range(256))


def _feature(chunk: bytes) -> int:
    """Slot of a chunk's shape: letters, capitals and digits as runs."""
    return xxhash.xxh3_64_intdigest(_RUNS.sub(rb"\1", chunk.translate(_SHAPE))) & ((1 << BITS) - 1)


def _dense(s: dict[str, float]) -> list[float]:
    return [1.0, math.log1p(s["n"]) / 5, s["letters"], s["upper"], 10 * s["symbols"], s["distinct"], s["top"], s["short"],
            math.log1p(s["sentence"]) / 3, min(s["width"], 20.0) / 10]


def _fit_scorer(texts: list[str], target: np.ndarray) -> dict:
    rows, cols, vals, dense = [], [], [], []
    for i, t in enumerate(texts):
        data = t.encode()
        chunks = data.split()
        dense.append(_dense(statistics(data, chunks)))
        for f, c in Counter(map(_feature, chunks)).items():
            rows.append(i)
            cols.append(f)
            vals.append(c / len(chunks))
    rows, cols, vals = np.array(rows, np.int64), np.array(cols, np.int64), np.array(vals)
    x = np.array(dense)
    w, d = np.zeros(1 << BITS), np.zeros(x.shape[1])
    state = [np.zeros(len(w) + len(d)), np.zeros(len(w) + len(d))]
    for step in range(1, STEPS + 1):
        z = np.bincount(rows, vals * w[cols], len(texts)) + x @ d
        err = target - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        grad = np.concatenate([np.bincount(cols, vals * err[rows], len(w)), x.T @ err]) / len(texts)
        grad -= 1e-4 * np.concatenate([w, d])
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad * grad
        move = 0.1 * (state[0] / (1 - 0.9 ** step)) / (np.sqrt(state[1] / (1 - 0.99 ** step)) + 1e-8)
        w, d = w + move[:len(w)], d + move[len(w):]
    return {"words": w, "dense": d}


def fit(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> dict | None:
    """Labeller accuracies over all documents and a scorer from a bounded
    sample; None for an empty table.

    The pattern counts read every whole text.  Of ``sample_docs`` distinct texts
    of any length (expected, fewer where SAMPLE_CHARS code points are reached,
    at least one; by a hash of the text, so reruns agree) the whole text's votes
    and at most SLICE_CHARS code points reach the driver, each once however
    many copies it has.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t"))

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        for b in batches:
            seen.update(map(pattern, b.column(0).to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int32()), pa.array(seen.values(), pa.int64())],
                                         names=["pattern", "n"])

    counts = {r["pattern"]: r["n"] for r in map_batches(texts, patterns, "pattern int, n long")
              .groupBy("pattern").agg(F.sum("n").alias("n")).collect()}
    total = sum(counts.values())
    if not total:
        return None
    model = estimate(counts)
    span = 1 << 40
    draw = F.pmod(F.xxhash64("t", F.lit(13)), F.lit(span))
    sizes = (texts.select(draw.alias("draw"), F.least(F.length("t"), F.lit(SLICE_CHARS)).alias("chars")).distinct()
             .agg(F.count("*").alias("n"), F.sum("chars").alias("chars"), F.min("draw").alias("first")).first())
    rate = min(sample_docs / sizes["n"], SAMPLE_CHARS / max(1, sizes["chars"]))
    drawn = texts.filter(draw < max(sizes["first"] + 1, min(span, math.ceil(rate * span)))).distinct()

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [pattern(t) for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("part"), pa.array(found, pa.int32())], names=["part", "pattern"])

    rows = map_batches(drawn.select("t", slice_of(F.col("t"), SLICE_CHARS).alias("part")), voted, "part string, pattern int").distinct()
    sample = sorted({(xxhash.xxh64_intdigest(r["part"].encode(), 2), r["part"], r["pattern"]) for r in rows.collect()})
    own = [t for _, t, _ in sample]
    target = np.array([model["posterior"].get(p, model["prior"]) for _, _, p in sample])
    model["scorer"] = _fit_scorer(own, target)
    return model


def score(docs: DataFrame, model: dict | None, keep: list[Column], keep_schema: str, text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: the ``keep`` columns, then score (0 to 1),
    weak_label (posterior of the row's votes) and predicted (score >= threshold).

    Null counts as empty; an empty text is scored on its votes and statistics
    like any other.  Without a model (empty table) there are no rows to score.
    """
    prepare(docs.sparkSession)
    n_keep = len(keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 3 ** labellers posteriors and 2 ** BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, float] = {}
        for b in batches:
            m = shared.value
            if len(known) > _CACHE_CHUNKS:
                known.clear()
            values, weak = [], []
            for t in b.column(n_keep).to_pylist():
                data = (t or "").encode()
                chunks = data.split()
                s = statistics(data, chunks)
                p = 0
                for labeller in LABELLERS:
                    p = 3 * p + labeller(s)
                for c in set(chunks):
                    if c not in known:
                        known[c] = float(m["scorer"]["words"][_feature(c)])
                z = float(np.dot(_dense(s), m["scorer"]["dense"]))
                z += sum(map(known.__getitem__, chunks)) / max(1, len(chunks))
                values.append(1 / (1 + math.exp(-min(30.0, max(-30.0, z)))))
                weak.append(m["posterior"].get(p, m["prior"]))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n_keep], pa.array(values, pa.float64()), pa.array(weak, pa.float64()),
                 pa.array([int(v >= threshold) for v in values], pa.int32())],
                names=[*b.schema.names[:n_keep], "score", "weak_label", "predicted"])

    return map_batches(docs.select(*keep, F.col(text).alias("__text")), run,
                       f"{keep_schema}, score double, weak_label double, predicted int")
