"""Near-duplicate embeddings by lattice hashing.

A vector is projected to BLOCKS * 8 random orthonormal directions and every
eight of them are decoded to the nearest point of the E8 lattice; the points
together are the vector's cell of one table.  It is entered in its own cell
and, for every block, in the neighbouring cell of the other coset of D8.
Vectors of one label that meet in a cell of any table are compared by cosine
in double precision.

Equal vectors collapse to one representative first.  Cells are compared in
blocks of bounded size and write only a spanning forest of the links found;
the links of a vector are then counted inside its component, again in blocks,
so that each is counted once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import connected_components, map_batches, prepare, written

THRESHOLD = 0.98
TABLES = 6
BLOCKS = 2
SCALE = 3.0
SEED = 20240601
# Vectors that meet in one comparison: at most two blocks of this many.
GROUP = 512
# Groups up to this size are compared many at a time and write all their links;
# larger ones write a spanning forest.
SMALL = 8


def decode_e8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest point of E8 to each row of eight, doubled to integers, and
    the nearest point of the other coset of D8."""
    def d8(y: np.ndarray) -> np.ndarray:
        f = np.rint(y)
        d = y - f
        odd = (f.sum(axis=1).astype(np.int64) & 1) == 1
        worst = np.abs(d).argmax(axis=1)
        at = np.arange(len(y))
        f[at, worst] += np.where(odd, np.where(d[at, worst] >= 0, 1.0, -1.0), 0.0)
        return f

    whole, half = d8(x), d8(x - 0.5) + 0.5
    near = (((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1))[:, None]
    doubled = lambda a: np.rint(2 * a).astype(np.int64)
    return doubled(np.where(near, whole, half)), doubled(np.where(near, half, whole))


def cells(unit: np.ndarray, tables: int = TABLES, blocks: int = BLOCKS, scale: float = SCALE,
          seed: int = SEED) -> np.ndarray:
    """64-bit cell keys per unit vector: per table the own cell, then one
    neighbour per block.  The projections depend on the dimension and seed."""
    dim = unit.shape[1]
    rng = np.random.default_rng([seed, dim])
    weights = rng.integers(1, 2**63, size=(tables, blocks * 8 + 1), dtype=np.uint64) | np.uint64(1)
    # in few dimensions the directions are fewer than 8 * blocks: pad with zeros
    width = 8 * blocks
    spread = scale * np.sqrt(max(dim, width) / 64.0)
    out = []
    for t in range(tables):
        q, _ = np.linalg.qr(rng.standard_normal((dim, max(dim, 1))))
        q = np.pad(q[:, :width], ((0, 0), (0, max(0, width - dim))))
        y = unit @ q * spread
        own, other = zip(*(decode_e8(y[:, 8 * b:8 * b + 8]) for b in range(blocks)))
        for flip in range(-1, blocks):
            point = np.concatenate([other[b] if b == flip else own[b] for b in range(blocks)], axis=1)
            key = (point.astype(np.uint64) * weights[t, :-1]).sum(axis=1, dtype=np.uint64) + weights[t, -1]
            key = (key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            out.append((key ^ (key >> np.uint64(29))).view(np.int64))
    return np.stack(out, axis=1)


def _matrix(values: Iterable[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(v, np.float64) for v in values])
    # by the largest component first: no overflow, and underflow only where it is lost anyway
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id",
                           embedding: str = "embedding", label: str = "label", tables: int = TABLES) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per input row.

    Rows are linked if their labels are equal and not null and their cosine is
    at least ``threshold``.  n_links counts the other rows that are linked;
    component_id is the smallest vec_id reachable, itself included; kept marks
    that row.  Vectors that are null, empty, zero or hold null or non-finite
    components, and rows without a label or an id, are linked with nothing
    (without an id: component_id null, kept).  Vectors of different lengths
    are never linked.  Rows that repeat an id are one node; an empty table
    gives no rows; other columns are not read.
    """
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                          F.col(embedding).cast("array<double>").alias("v"))

    def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, l, v in zip(*(c.to_pylist() for c in b.columns)):
                a = None if v is None or i is None or l is None or None in v else np.array(v, np.float64)
                usable = a is not None and len(a) and np.isfinite(a).all() and a.any()
                out.append((a + 0.0).tobytes() if usable else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())],
                                             names=["vec_id", "label", "v"])

    flat = written(map_batches(rows, flatten, "vec_id long, label string, v binary"), "vectors")
    classes = written(flat.filter("v is not null").groupBy("label", "v")
                      .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "vector-classes")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            frame = b.to_pandas()
            for _, part in frame.groupby(frame["v"].map(len)):
                unit = _matrix(part["v"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part["rep"].to_numpy(np.int64)), pa.array(part["label"].tolist(), pa.string()),
                     pa.array(part["v"].tolist(), pa.binary()), pa.array(list(cells(unit, tables)), pa.list_(pa.int64()))],
                    names=["rep", "label", "v", "cells"])

    entered = (map_batches(classes.select("rep", "label", "v"), hashed,
                           "rep long, label string, v binary, cells array<long>")
               .select("rep", "v", F.explode("cells").alias("cell"), "label")
               .select("rep", "v", F.xxhash64("cell", "label", F.length("v")).alias("cell")))
    # written: a join straight to an aggregate could not split a hot cell
    crowded = written(entered.groupBy("cell").agg(F.count("*").alias("m")).filter("m > 1"), "crowded-cells")

    def links(part: Groups) -> pa.RecordBatch:
        a, b = part.links(threshold)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    edges = _streamed(_blocks(entered.join(crowded, "cell"), "cell"), ["cell", "i", "j"], ["rep"], links, "a long, b long")
    parts = connected_components(edges)
    weight = classes.select("label", "v", "rep", "n")
    if parts is None:
        linked = weight.withColumn("component", F.col("rep")).withColumn("far", F.lit(0).cast("long"))
    else:
        inside = written(weight.join(parts.withColumnRenamed("id", "rep"), "rep"), "linked-vectors")
        m = written(inside.groupBy("component", "label").agg(F.count("*").alias("m")), "component-sizes")

        def count(part: Groups) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([part.table.column("rep"), part.table.column("label"), part.table.column("v"),
                                               pa.array(part.weighed_hits(threshold), pa.int64())],
                                              names=["rep", "label", "v", "far"])

        far = (_streamed(_blocks(inside.join(m, ["component", "label"]).withColumn("size", F.length("v")), "component"),
                         ["component", "label", "size", "i", "j"], ["rep", "n"], count, "rep long, label string, v binary, far long")
               .groupBy("rep", "label", "v").agg(F.sum("far").alias("far")))
        linked = (weight.join(parts.withColumnRenamed("id", "rep"), "rep", "left")
                  .join(far, ["rep", "label", "v"], "left")
                  .select("label", "v", "n", F.coalesce("component", "rep").alias("component"),
                          F.coalesce("far", F.lit(0)).alias("far")))
    own = linked.select("label", "v", (F.col("far") + F.col("n") - 1).alias("n_links"), "component")
    return (flat.join(own, ["label", "v"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def _blocks(members: DataFrame, group: str) -> DataFrame:
    """Deal the m members of a group to blocks; one row per pair of blocks."""
    return (members.withColumn("blocks", F.ceil(F.col("m") / GROUP).cast("int"))
            .withColumn("mine", F.pmod(F.xxhash64("rep", "v"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
            .drop("other", "blocks", "m"))


def _streamed(blocks: DataFrame, keys: list[str], columns: list[str], work: Callable[[Groups], pa.RecordBatch],
              schema: str) -> DataFrame:
    """Rows dealt out and sorted by ``keys``; ``work`` gets whole groups, as many
    at a time as a batch holds.  A task keeps one batch and one group."""
    dealt = (blocks.select(*keys, "mine", "v", *columns).repartition(*keys).sortWithinPartitions(*keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            last, first = held[0].slice(held[0].num_rows - 1), b.slice(b.num_rows - 1)
            if len(held) > 1 and _same(last, first, keys):
                continue  # all one group so far
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            starts = _starts(table, keys)
            if len(starts) > 1:
                yield work(Groups(table.slice(0, starts[-1]), starts[:-1]))
            held = [table.slice(starts[-1])]
        if held:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield work(Groups(table, _starts(table, keys)))

    return map_batches(dealt, run, schema)


def _same(a: pa.RecordBatch, b: pa.RecordBatch, keys: list[str]) -> bool:
    return all(a.column(k)[0] == b.column(k)[0] for k in keys)


def _starts(table: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """First row of every run of equal keys."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        column = table.column(k)
        codes = column.dictionary_encode().indices.to_numpy() if pa.types.is_string(column.type) else column.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


class Groups:
    """Consecutive groups of rows; vectors of one group have one length."""

    def __init__(self, table: pa.RecordBatch, starts: np.ndarray):
        self.table, self.starts = table, starts
        self.sizes = np.diff(np.append(starts, table.num_rows))
        self.data = table.column("v").to_pylist()
        # a group of two blocks compares across them only
        self.across = (table.column("i").to_numpy() != table.column("j").to_numpy())[starts]
        self.mine = table.column("mine").to_numpy()

    def hits(self, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, links) of all groups of one size and length together:
        rows groups x size, links groups x size x size."""
        length = np.array([len(self.data[s]) for s in self.starts])
        for m, d in sorted(set(zip(self.sizes.tolist(), length.tolist()))):
            chosen = np.flatnonzero((self.sizes == m) & (length == d))
            if m < 2:
                continue
            step = max(1, (1 << 22) // (m * m + m * d // 8))
            for at in range(0, len(chosen), step):
                groups = chosen[at:at + step]
                rows = self.starts[groups][:, None] + np.arange(m)
                unit = _matrix([self.data[r] for r in rows.ravel()]).reshape(len(groups), m, -1)
                hit = unit @ unit.transpose(0, 2, 1) >= threshold
                hit[:, np.arange(m), np.arange(m)] = False
                block = self.mine[rows]
                hit &= ~self.across[groups][:, None, None] | (block[:, :, None] != block[:, None, :])
                yield rows, hit

    def links(self, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        ids = self.table.column("rep").to_numpy()
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for rows, hit in self.hits(threshold):
            if rows.shape[1] <= SMALL:
                g, x, y = np.nonzero(np.triu(hit))
                a.append(ids[rows[g, x]])
                b.append(ids[rows[g, y]])
                continue
            for own, links in zip(rows, hit):
                if links.any():
                    found = np.array(_forest(links, ids[own]), np.int64).reshape(-1, 2)
                    a.append(found[:, 0])
                    b.append(found[:, 1])
        return np.concatenate(a), np.concatenate(b)

    def weighed_hits(self, threshold: float) -> np.ndarray:
        """Per row, the weights ``n`` of the rows that it is linked with."""
        n = self.table.column("n").to_numpy()
        out = np.zeros(self.table.num_rows, np.int64)
        for rows, hit in self.hits(threshold):
            out[rows] = (hit @ n[rows][:, :, None])[:, :, 0]
        return out


def _forest(hit: np.ndarray, own: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the links, breadth first."""
    ids = own.tolist()
    seen = np.zeros(len(ids), bool)
    out = []
    for start in range(len(ids)):
        if seen[start]:
            continue
        seen[start] = True
        queue = [start]
        while queue:
            x = queue.pop()
            new = np.flatnonzero(hit[x] & ~seen)
            seen[new] = True
            queue += new.tolist()
            out += [(ids[x], ids[y]) for y in new.tolist()]
    return out
