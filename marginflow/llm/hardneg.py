"""Hard negatives by anchor-clustered shared lists.

Anchors are clustered by direction.  For a cluster with centroid c and widest
member angle t, no member u scores a candidate i above
|u| * |i| * cos(max(0, angle(i, c) - t)), so one list of the candidates, sorted
by |i| * cos(...) once, serves all members: each walks it from the top until
its worst kept score is above the bound of what is left.

A list is cut into segments (the rows that a task holds at a time); a task
keeps every anchor's best over all its segments, and the tasks' bests are
merged by rank.  Two walks are made: one for the positives (best rows of the
anchor's label), one for the negatives, whose score bands follow from the
positives.  Scores are whole numbers, compared exactly; the bounds are only
used with a margin for rounding.

Anchors grow with the table, so they are taken in rounds of about
``ROUND_BYTES``; a round's clusters are broadcast, and a round scans the rows
twice.  The stated query set meets all rows in blocks; no pair is joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginflow.llm.common import map_batches, prepare, written
from marginflow.llm.vectors import packed, scaled, unpacked, width_of

SCALE = 256.0
# Members of one list, rows of one segment, list entries scored at a time.
MEMBERS = 512
SEGMENT = 16_384
STEP = 2_048
# Vectors of the anchors that one round broadcasts.
ROUND_BYTES = 32 << 20
# Centroids are fitted on about this many anchors.
SAMPLE = 4_096
CENTROIDS = 256
SEED = 20240617
# Margin of the angular bound, in radians, and of the product, relative.
ANGLE_MARGIN, SCORE_MARGIN = 1e-6, 1e-9


@dataclass
class Cluster:
    """Members of one shared list (an array entry each) and what bounds it."""

    ids: np.ndarray
    ties: np.ndarray
    labels: list[str]
    vectors: np.ndarray
    centre: np.ndarray
    angle: float
    norms: np.ndarray
    # per member and positive: the band of scores that its negatives may have
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def mine(vectors: DataFrame, is_anchor: Column, label: Column, vec_id: str = "vec_id", embedding: str = "embedding",
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the inner product of the floored multiples (SCALE) of two
    vectors.  An anchor's positives are its ``positives`` best other rows of the
    same label; for each, the ``negatives`` best rows of another label with
    low * positive_score <= 100 * negative_score <= high * positive_score are
    returned, ranked from 1; ties go to the smaller id.  An anchor without
    positives, or a positive without a row in its band, gives no row.

    Rows without an id or a label, and vectors that are null or hold a null or
    non-finite entry, take no part.  Rows that repeat id, label and vector are
    one row; rows that share only the id are rows of their own (ties between
    them go by a hash of label and vector).  A shorter vector counts as ending
    in zeros; entries are clamped so that every score fits 64 bits (beyond
    about 4e8 / sqrt(dimensions), before scaling: / 256).  An empty table gives
    no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    prepare(spark)
    named = vectors.select(F.col(vec_id).cast("long").alias("id"), label.cast("string").alias("label"),
                           F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.col(embedding).cast("array<double>").alias("v"))
    named = named.filter("id is not null and label is not null")
    width = width_of(named, "v")
    most = math.isqrt((2**63 - 1) // max(1, width))

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, usable = scaled(b.column("v"), SCALE, width, most)
            kept = pa.array(usable)
            yield pa.RecordBatch.from_arrays([b.column(i).filter(kept) for i in range(3)] + [packed(x)],
                                             names=["id", "label", "anchor", "data"])

    rows = written(map_batches(named, scale, "id long, label string, anchor boolean, data binary").distinct()
                   .withColumn("tie", F.xxhash64("label", "data")), "vectors")
    anchors = _clustered(rows.filter("anchor").select("id", "tie", "label", "data"), width)
    rounds = [r[0] for r in anchors.select("round").distinct().orderBy("round").collect()]
    found = None
    for r in rounds:
        part = written(_round(rows, anchors.filter(F.col("round") == r), width, positives, negatives, low, high), "negatives")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], _FOUND)
    return found


_FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _clustered(anchors: DataFrame, width: int) -> DataFrame:
    """The anchors with their list (cluster, part) and round, written."""
    n = anchors.count()
    share = F.pmod(F.xxhash64("id", "tie", F.lit(SEED)), F.lit(1 << 20)) < F.lit(math.ceil(min(1.0, SAMPLE / max(1, n)) * (1 << 20)))
    sample = anchors.filter(share).select("data").toArrow().column("data").combine_chunks() if n else pa.array([], pa.binary())
    centres = _centroids(_unit(unpacked(sample, width).astype(np.float64)), min(CENTROIDS, max(1, n // 128)))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            unit = _unit(unpacked(b.column("data"), width).astype(np.float64))
            at = (unit @ centres.T).argmax(axis=1) if len(unit) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at.astype(np.int32))], names=[*b.schema.names, "cluster"])

    placed = written(map_batches(anchors, nearest, "id long, tie long, label string, data binary, cluster int"), "anchors")
    sizes = F.broadcast(placed.groupBy("cluster").agg(F.count("*").alias("m")))  # at most CENTROIDS rows
    rounds = max(1, -(-n * max(1, width) * 8 // ROUND_BYTES))
    part = F.pmod(F.xxhash64("id", "tie"), F.ceil(F.col("m") / MEMBERS)).cast("int")
    return written(placed.join(sizes, "cluster").withColumn("part", part)
                   .withColumn("round", F.pmod(F.xxhash64("cluster", "part"), F.lit(rounds))).drop("m"), "anchor-lists")


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def _centroids(unit: np.ndarray, k: int, steps: int = 8) -> np.ndarray:
    """Spherical k-means on the (bounded) sample, from a seeded start."""
    if not len(unit):
        return np.zeros((1, unit.shape[1]))
    rng = np.random.default_rng([SEED, k])
    centres = unit[rng.permutation(len(unit))[:k]]
    for _ in range(steps):
        at = (unit @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, at, unit)
        centres = np.where((total != 0).any(axis=1, keepdims=True), _unit(total), centres)
    return centres


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def _clusters(anchors: DataFrame, width: int) -> list[Cluster]:
    """One round's lists (bounded by ROUND_BYTES, up to the luck of the hash)."""
    got = anchors.select("id", "tie", "label", "data", "cluster", "part").toArrow().combine_chunks()
    vectors = unpacked(got.column("data").combine_chunks(), width)
    ids, ties = got.column("id").to_numpy(), got.column("tie").to_numpy()
    labels, lists = got.column("label").to_pylist(), np.stack([got.column("cluster").to_numpy(), got.column("part").to_numpy()], axis=1)
    out = []
    for key in np.unique(lists, axis=0):
        own = np.flatnonzero((lists == key).all(axis=1))
        own = own[np.lexsort((ties[own], ids[own]))]
        unit = _unit(vectors[own].astype(np.float64))
        centre = _unit(unit.sum(axis=0, keepdims=True))[0]
        norms = np.sqrt((vectors[own].astype(np.float64) ** 2).sum(axis=1))
        # a zero vector scores 0 with everything, whatever its angle
        angle = float(_angles(unit @ centre)[norms > 0].max(initial=0.0))
        out.append(Cluster(ids[own], ties[own], [labels[i] for i in own], vectors[own], centre, angle, norms))
    return out


def _round(rows: DataFrame, anchors: DataFrame, width: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The result of one round of anchors."""
    sc = rows.sparkSession.sparkContext
    clusters = _clusters(anchors, width)
    lists = sc.broadcast(clusters)
    best = written(_merged(_walked(rows, lists, width, positives, 1), positives), "positives")
    # bounded: `positives` rows per anchor of the round
    got = best.select("list", "member", "rank", "score").toArrow().combine_chunks()
    for c, cluster in enumerate(clusters):
        cluster.low = np.full((len(cluster.ids), positives), np.iinfo(np.int64).max)
        cluster.high = np.full((len(cluster.ids), positives), np.iinfo(np.int64).min)
    for c, m, r, s in zip(*(got.column(k).to_pylist() for k in got.column_names)):
        clusters[c].low[m, r - 1] = -((-low * s) // 100)
        clusters[c].high[m, r - 1] = (high * s) // 100
    banded = sc.broadcast(clusters)
    hard = _merged(_walked(rows, banded, width, negatives, positives), negatives)
    pairs = best.select("list", "member", F.col("rank").alias("positive"), F.col("anchor_id"), F.col("id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    return (hard.select("list", "member", "positive", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(pairs, ["list", "member", "positive"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def _merged(local: DataFrame, k: int) -> DataFrame:
    """The best k of what the tasks kept for a member (and positive): k from
    each task at most."""
    by = Window.partitionBy("list", "member", "positive").orderBy(F.desc("score"), "id", "tie")
    return local.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def _walked(rows: DataFrame, lists, width: int, k: int, bands: int) -> DataFrame:
    """Each task's best k candidates per member and band.  Without bands set,
    candidates are the other rows of the member's label; with them, the rows
    of other labels whose score is within the band."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters: list[Cluster] = lists.value
        codes: dict[str, int] = {}
        code = lambda labels: np.array([codes.setdefault(x, len(codes)) for x in labels], np.int64)
        members = [code(c.labels) for c in clusters]
        bests = [Best(len(c.ids) * bands, k) for c in clusters]
        for ids, ties, labels, x in _segments(batches, width):
            own = code(labels)
            for c, m, best in zip(clusters, members, bests):
                _walk_list(c, m, best, ids, ties, own, x, bands)
        for at, (c, best) in enumerate(zip(clusters, bests)):
            slot, score, i, tie = best.rows()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(slot), at, np.int32)), pa.array((slot // bands).astype(np.int32)),
                 pa.array((slot % bands + 1).astype(np.int32)), pa.array(c.ids[slot // bands]), pa.array(score), pa.array(i), pa.array(tie)],
                names=["list", "member", "positive", "anchor_id", "score", "id", "tie"])

    return map_batches(rows.select("id", "tie", "label", "data"), walk,
                       "list int, member int, positive int, anchor_id long, score long, id long, tie long")


def _segments(batches: Iterator[pa.RecordBatch], width: int):
    """The task's rows, SEGMENT at a time (fewer of long vectors)."""
    most = max(1, min(SEGMENT, (32 << 20) // max(1, 8 * width)))
    held: list[pa.RecordBatch] = []

    def out():
        t = pa.Table.from_batches(held).combine_chunks()
        return (t.column("id").to_numpy(), t.column("tie").to_numpy(), t.column("label").to_pylist(),
                unpacked(t.column("data").combine_chunks(), width))

    for b in batches:
        while b.num_rows:
            room = most - sum(h.num_rows for h in held)
            held.append(b.slice(0, room))
            b = b.slice(min(room, b.num_rows))
            if sum(h.num_rows for h in held) == most:
                yield out()
                held.clear()
    if held:
        yield out()


class Best:
    """The best k (score, then smaller id, then tie) of each slot."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.count = np.zeros(slots, np.int64)
        self.score = np.zeros((slots, k), np.int64)
        self.id = np.zeros((slots, k), np.int64)
        self.tie = np.zeros((slots, k), np.int64)

    def full(self, slots: np.ndarray) -> np.ndarray:
        return self.count[slots] == self.k

    def worst(self, slots: np.ndarray) -> np.ndarray:
        return self.score[slots, self.k - 1]

    def rows(self) -> tuple[np.ndarray, ...]:
        slot, at = np.nonzero(np.arange(self.k) < self.count[:, None])
        return slot, self.score[slot, at], self.id[slot, at], self.tie[slot, at]

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, ties: np.ndarray) -> None:
        if not len(slot):
            return
        touched = np.unique(slot)
        at_slot, at = np.nonzero(np.arange(self.k) < self.count[touched][:, None])
        old = touched[at_slot]
        slot, score = np.concatenate([slot, old]), np.concatenate([score, self.score[old, at]])
        ids, ties = np.concatenate([ids, self.id[old, at]]), np.concatenate([ties, self.tie[old, at]])
        order = np.lexsort((ties, ids, -score, slot))
        slot, score, ids, ties = slot[order], score[order], ids[order], ties[order]
        first = np.concatenate([[True], slot[1:] != slot[:-1]])
        place = np.arange(len(slot)) - np.maximum.accumulate(np.where(first, np.arange(len(slot)), 0))
        kept = place < self.k
        self.count[touched] = 0
        self.score[slot[kept], place[kept]], self.id[slot[kept], place[kept]] = score[kept], ids[kept]
        self.tie[slot[kept], place[kept]] = ties[kept]
        np.add.at(self.count, slot[kept], 1)


def _walk_list(c: Cluster, labels: np.ndarray, best: Best, ids: np.ndarray, ties: np.ndarray, own: np.ndarray,
               x: np.ndarray, bands: int) -> None:
    """Sort the segment by the cluster's bound; every member walks it until all
    its bands are certified."""
    y = x.astype(np.float64)
    norms = np.sqrt((y * y).sum(axis=1))
    angle = _angles(y @ c.centre / np.maximum(norms, 1e-300))
    bound = norms * np.cos(np.maximum(0.0, angle - c.angle - ANGLE_MARGIN))
    order = np.argsort(-bound, kind="stable")
    # doubles add whole numbers exactly below 2^53
    exact = float(np.abs(c.vectors).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1]) < 2.0**53
    mine = c.vectors.astype(np.float64) if exact else c.vectors
    every = np.arange(len(c.ids))
    slots = every[:, None] * bands + np.arange(bands)
    active = every
    for start in range(0, len(order), STEP):
        left = c.norms[active] * bound[order[start]]
        left = left + np.abs(left) * SCORE_MARGIN + 1e-3
        done = best.full(slots[active]) & (best.worst(slots[active]) > left[:, None])
        if c.low is not None:
            done |= c.low[active] > left[:, None]  # also where there is no such positive
        active = active[~done.all(axis=1)]
        if not len(active):
            return
        take = order[start:start + STEP]
        score = (mine[active] @ (y if exact else x)[take].T).astype(np.int64)
        same = labels[active][:, None] == own[take]
        if c.low is None:
            same &= (ids[take] != c.ids[active][:, None]) | (ties[take] != c.ties[active][:, None])
            _offer(best, slots[active, 0], score, same, ids[take], ties[take])
        else:
            for b in range(bands):
                within = ~same & (score >= c.low[active, b][:, None]) & (score <= c.high[active, b][:, None])
                _offer(best, slots[active, b], score, within, ids[take], ties[take])


def _offer(best: Best, slots: np.ndarray, score: np.ndarray, usable: np.ndarray, ids: np.ndarray, ties: np.ndarray) -> None:
    """Add the usable candidates that are among the best k of their slot."""
    worst = np.where(best.full(slots), best.worst(slots), np.iinfo(np.int64).min)
    if score.shape[1] > best.k:
        masked = np.where(usable, score, np.iinfo(np.int64).min)
        worst = np.maximum(worst, np.partition(masked, score.shape[1] - best.k, axis=1)[:, -best.k])
    who, which = np.nonzero(usable & (score >= worst[:, None]))
    best.add(slots[who], score[who, which], ids[which], ties[which])
