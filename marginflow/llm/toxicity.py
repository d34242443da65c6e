"""Toxic spans by a linear-chain conditional random field.

Fit (on a bounded, documented sample of labelled documents): words and word
beginnings that occur far more often in toxic than in clean documents label
the tokens of toxic documents; a two-state chain with hashed word features
is trained on those tokens; a logistic curve, fitted on marginals of halves
of the sample that their chain has not seen, turns a document's marginals into
its score.

Scoring: forward-backward gives every token's marginal probability of being
toxic; the document gets its score and the offsets of offending tokens.
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

# Fit: documents (expected) and code points of each label, and code points of
# one document (a longer one is represented by a slice).
SAMPLE_DOCS = 1_500
SAMPLE_CHARS = 8_000_000
SLICE_CHARS = 131_072
# A feature marks tokens if it is in MIN_SUPPORT toxic documents and LIFT
# times as frequent there as in clean ones.
MIN_SUPPORT = 4
LIFT = 6.0
BITS = 18
STEPS = 60
# A token is reported if its marginal reaches this.
SPAN_MARGINAL = 0.5
THRESHOLD = 0.3
# Tokens and documents that a task scores at once, words it remembers.
_BLOCK_TOKENS = 2_000_000
_BLOCK_DOCS = 8_192
_CACHE_WORDS = 1 << 20

_FOLD = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_TOKEN = re.compile(r"[A-Za-z\x80-\U0010ffff]+")


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters and non-ASCII characters."""
    return (text or "").lower().encode("utf-8", "replace").translate(_FOLD).split()


def features(word: bytes) -> list[bytes]:
    """The word, its beginnings and its end."""
    w = word.decode("utf-8", "replace")
    return [b"w:" + word, *(b"p:" + w[:k].encode() for k in range(3, 9) if len(w) > k), b"s:" + w[-4:].encode()]


def _slots(word: bytes) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(f) & ((1 << BITS) - 1) for f in features(word)])


class Layout:
    """Tokens of many documents side by side, time step by time step: step t
    holds the documents with more than t tokens, longest first."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        self.order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max(initial=0))
        self.active = np.searchsorted(-lengths[self.order], -np.arange(longest), side="left")  # lengths > t
        self.starts = np.concatenate([[0], np.cumsum(self.active)])

    def place(self) -> np.ndarray:
        """For tokens in document order: their place in step order."""
        rank = np.empty(len(self.lengths), np.int64)
        rank[self.order] = np.arange(len(self.lengths))
        total = int(self.lengths.sum())
        first = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]) if len(self.lengths) else np.empty(0, np.int64)
        step = np.arange(total) - np.repeat(first, self.lengths)
        return self.starts[step] + np.repeat(rank, self.lengths)


def forward_backward(odds: np.ndarray, layout: Layout, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ratios state 1 : state 0 of the forward and backward messages.

    ``odds`` are the exponentiated emission scores in step order, ``trans`` the
    2 x 2 matrix of exponentiated transition scores.
    """
    alpha, beta = np.empty_like(odds), np.ones_like(odds)
    s, n = layout.starts, layout.active
    for t in range(len(n)):
        here = slice(s[t], s[t + 1])
        if t == 0:
            alpha[here] = odds[here]
        else:
            r = alpha[s[t - 1]:s[t - 1] + n[t]]
            alpha[here] = odds[here] * (trans[0, 1] + r * trans[1, 1]) / (trans[0, 0] + r * trans[1, 0])
    for t in range(len(n) - 2, -1, -1):
        after = slice(s[t + 1], s[t + 2])
        x = odds[after] * beta[after]
        beta[s[t]:s[t] + n[t + 1]] = (trans[1, 0] + trans[1, 1] * x) / (trans[0, 0] + trans[0, 1] * x)
    return alpha, beta


def _weak_tokens(docs: list[list[bytes]], labels: list[int]) -> list[np.ndarray]:
    """Token labels: 1 where a marked feature stands in a toxic document."""
    counts = [Counter(), Counter()]
    cache: dict[bytes, list[bytes]] = {}
    for words, y in zip(docs, labels):
        own = set()
        for w in set(words):
            if w not in cache:
                cache[w] = features(w)
            own.update(cache[w])
        counts[y].update(own)
    n1, n0 = max(1, sum(labels)), max(1, len(labels) - sum(labels))
    marked = {f for f, k in counts[1].items()
              if k >= MIN_SUPPORT and (k / n1) >= LIFT * ((counts[0][f] + 0.5) / n0)}
    hit = {w for w, fs in cache.items() if not marked.isdisjoint(fs)}
    return [np.fromiter((y and w in hit for w in words), np.float64, len(words)) for words, y in zip(docs, labels)]


def _train(docs: list[list[bytes]], tags: list[np.ndarray], l2: float = 1e-4) -> dict:
    """Maximum likelihood by Adam steps over the whole (bounded) sample."""
    index: dict[bytes, int] = {}
    token = [np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words)) for words in docs]
    layout = Layout(np.array([len(t) for t in token], np.int64))
    place = layout.place()
    word = np.empty(len(place), np.int64)
    gold = np.empty(len(place))
    word[place] = np.concatenate(token)
    gold[place] = np.concatenate(tags)
    slots = [_slots(w) for w in index]
    rows = np.repeat(np.arange(len(slots)), [len(x) for x in slots])
    cols = np.concatenate(slots)
    used, cols = np.unique(cols, return_inverse=True)
    s, n = layout.starts, layout.active
    pairs_from = np.concatenate([np.arange(s[t], s[t] + n[t + 1]) for t in range(len(n) - 1)] or [np.empty(0, np.int64)])
    pairs_to = np.concatenate([np.arange(s[t + 1], s[t + 2]) for t in range(len(n) - 1)] or [np.empty(0, np.int64)])
    base = math.log((gold.sum() + 1) / (len(gold) + 2))
    theta = np.concatenate([np.zeros(len(used)), [base, 0.0, 0.0, 0.0]])  # weights, bias, 01, 10, 11
    g01 = float(((gold[pairs_from] == 0) & (gold[pairs_to] == 1)).sum())
    g10 = float(((gold[pairs_from] == 1) & (gold[pairs_to] == 0)).sum())
    g11 = float(((gold[pairs_from] == 1) & (gold[pairs_to] == 1)).sum())
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    scale = max(1.0, gold.sum())
    for step in range(1, STEPS + 1):
        emit = np.bincount(rows, theta[cols], len(slots)) + theta[-4]
        odds = np.exp(np.clip(emit, -30, 30))[word]
        trans = np.exp(np.clip(np.array([[0.0, theta[-3]], [theta[-2], theta[-1]]]), -10, 10))
        alpha, beta = forward_backward(odds, layout, trans)
        p = alpha * beta
        p = p / (1 + p)
        a, x = alpha[pairs_from], odds[pairs_to] * beta[pairs_to]
        e01, e10, e11 = trans[0, 1] * x, a * trans[1, 0], a * trans[1, 1] * x
        z = trans[0, 0] + e01 + e10 + e11
        diff = gold - p
        by_word = np.bincount(word, diff, len(slots))
        grad = np.concatenate([np.bincount(cols, by_word[rows], len(used)),
                               [diff.sum(), g01 - (e01 / z).sum(), g10 - (e10 / z).sum(), g11 - (e11 / z).sum()]]) / scale
        grad -= l2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + 0.25 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = theta[:-4]
    return {"weights": weights, "bias": float(theta[-4]),
            "trans": np.exp(np.clip(np.array([[0.0, theta[-3]], [theta[-2], theta[-1]]]), -10, 10))}


def _aggregates(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per document: 1, largest marginal, evidence of any toxic token,
    expected toxic tokens, their share."""
    out = np.zeros((len(lengths), 5))
    out[:, 0] = 1
    full = lengths > 0
    if full.any():
        first = np.concatenate([[0], np.cumsum(lengths[full])[:-1]])
        total = np.add.reduceat(p, first)
        out[full, 1] = np.maximum.reduceat(p, first)
        out[full, 2] = np.log1p(np.add.reduceat(-np.log1p(-np.minimum(p, 1 - 1e-9)), first))
        out[full, 3] = np.log1p(total)
        out[full, 4] = np.sqrt(total / lengths[full])
    return out


class Tagger:
    """Marginals and scores under a fitted model."""

    def __init__(self, model: dict):
        self.model = model
        self.odds: dict[bytes, float] = {}

    def marginals(self, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """(marginals in document order, tokens per document)."""
        known = self.odds
        if len(known) > _CACHE_WORDS:
            known.clear()
        w, bias = self.model["weights"], self.model["bias"]
        lengths = np.array([len(d) for d in docs], np.int64)
        layout = Layout(lengths)
        place = layout.place()
        flat = np.empty(len(place))
        at = 0
        for d in docs:
            for x in set(d):
                if x not in known:
                    known[x] = math.exp(min(30.0, max(-30.0, float(w[_slots(x)].sum()) + bias)))
            flat[place[at:at + len(d)]] = np.fromiter(map(known.__getitem__, d), np.float64, len(d))
            at += len(d)
        alpha, beta = forward_backward(flat, layout, self.model["trans"])
        p = alpha * beta
        return (p / (1 + p))[place], lengths

    def scores(self, p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_aggregates(p, lengths) @ self.model["curve"], -30, 30)))


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [1.0] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        beta += np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge @ beta)
    return beta


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        sample_docs: int = SAMPLE_DOCS) -> dict | None:
    """Model from a bounded sample of labelled rows (null labels and ids are
    left out); None if a label is missing altogether.

    The sample is drawn from ``labels`` before any text is joined:
    ``sample_docs`` rows of each label (expected; by a hash of the id, so reruns
    agree), whatever the length of their documents.  Their sizes come first; of
    each label the texts with the smallest hashes are taken, each as at most
    SLICE_CHARS code points, until SAMPLE_CHARS are reached (at least one).
    """
    rows = (labels.select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("y"))
            .filter("y in (0, 1) and id is not null"))
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return None
    span = 1 << 40
    draw = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(span))
    keep = F.when(F.col("y") == 1, draw < min(span, math.ceil(sample_docs / n[1] * span))).otherwise(
        draw < min(span, math.ceil(sample_docs / n[0] * span)))
    drawn = F.broadcast(rows.filter(keep))  # about 2 * sample_docs ids
    found = (docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
             .join(drawn, "id").select("y", "t", F.xxhash64("t", F.lit(19)).alias("hash")))
    sizes = found.select("y", "hash", F.least(F.length("t"), F.lit(SLICE_CHARS)).alias("chars")).distinct().collect()
    last: dict[int, int] = {}  # the largest hash that is taken, per label
    taken = dict.fromkeys((0, 1), 0)
    for y, h, chars in sorted(map(tuple, sizes)):
        if y not in last or taken[y] + chars <= SAMPLE_CHARS:
            last[y], taken[y] = h, taken[y] + chars
        else:
            taken[y] = SAMPLE_CHARS + 1  # nothing beyond the first that does not fit
    within = [(F.col("y") == y) & (F.col("hash") <= h) for y, h in last.items()]
    if len(within) < 2:
        return None
    found = found.filter(within[0] | within[1]).select(slice_of(F.col("t"), SLICE_CHARS).alias("t"), "y").collect()
    sample = sorted({(xxhash.xxh64_intdigest(r["t"].encode(), 1), r["t"], r["y"]) for r in found})
    del found
    once: dict[bytes, bytes] = {}  # one object per distinct word
    docs = [[once.setdefault(w, w) for w in words_of(t)] for _, t, _ in sample]
    labels = [y for _, _, y in sample]
    if len(set(labels)) < 2 or not any(docs):
        return None
    # the curve is fitted on marginals of documents that their chain has not seen
    parts, order = [], []
    for fold in range(2):
        seen = [i for i in range(len(docs)) if i % 2 != fold and docs[i]]
        rest = [i for i in range(len(docs)) if i % 2 == fold]
        if not seen or not rest:
            continue
        tags = _weak_tokens([docs[i] for i in seen], [labels[i] for i in seen])
        chain = Tagger(_train([docs[i] for i in seen], tags))
        parts.append(_aggregates(*chain.marginals([docs[i] for i in rest])))
        order += rest
    full = [i for i in range(len(docs)) if docs[i]]
    model = _train([docs[i] for i in full], _weak_tokens([docs[i] for i in full], [labels[i] for i in full]))
    if not parts:
        parts, order = [_aggregates(*Tagger(model).marginals(docs))], list(range(len(docs)))
    y = np.array([labels[i] for i in order], np.float64)
    share = n[1] / (n[0] + n[1])
    mean = min(max(y.mean(), 1e-6), 1 - 1e-6)
    weight = np.where(y == 1, share / mean, (1 - share) / (1 - mean))
    model["curve"] = _curve(np.concatenate(parts), y, weight)
    return model


def score(docs: DataFrame, model: dict | None, keep: list[Column], keep_schema: str, text: str = "text") -> DataFrame:
    """One row per input row: the ``keep`` columns, then score, predicted and
    spans (start, end in code points, marginal) of offending tokens.

    Null and empty texts have no token and get the score of a document without
    evidence.  Without a model every score is 0.  Only the text is an input.
    """
    prepare(docs.sparkSession)
    n_keep = len(keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS weights
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value) if shared.value else None

        def done(kept: list[pa.RecordBatch], texts: list[str | None], tokens: list[list[bytes]]) -> pa.RecordBatch:
            spans: list[list[dict]] = [[] for _ in texts]
            if tagger is None:
                values = np.zeros(len(texts))
            else:
                p, lengths = tagger.marginals(tokens)
                values = tagger.scores(p, lengths)
                ends = np.cumsum(lengths)
                hits = np.flatnonzero(p >= SPAN_MARGINAL)
                for d in np.unique(np.searchsorted(ends, hits, side="right")).tolist():
                    own = p[ends[d] - lengths[d]:ends[d]]
                    for m, q in zip(_TOKEN.finditer(texts[d] or ""), own):
                        if q >= SPAN_MARGINAL:
                            spans[d].append({"start": m.start(), "end": m.end(), "marginal": float(q)})
            merged = pa.Table.from_batches(kept).combine_chunks()
            columns = [merged.column(i).combine_chunks() for i in range(n_keep)]
            columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(values), pa.array((values >= THRESHOLD).astype(np.int32)), pa.array(spans, span_type)],
                names=[*merged.schema.names, "score", "predicted", "spans"])

        kept, texts, tokens, n = [], [], [], 0
        for b in batches:
            if not b.num_rows:
                continue
            own = b.column(n_keep).to_pylist()
            kept.append(b.select(list(range(n_keep))))
            texts += own
            found = [words_of(t) for t in own]
            tokens += found
            n += sum(map(len, found))
            if n >= _BLOCK_TOKENS or len(texts) >= _BLOCK_DOCS:
                yield done(kept, texts, tokens)
                kept, texts, tokens, n = [], [], [], 0
        if texts:
            yield done(kept, texts, tokens)

    return map_batches(docs.select(*keep, F.col(text).alias("__text")), run,
                       f"{keep_schema}, score double, predicted int, "
                       "spans array<struct<start: int, end: int, marginal: double>>")
