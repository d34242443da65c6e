"""Exact deduplication with Patricia tries.

Texts are dealt out by their length and a content hash.  Each task inserts
the full byte strings of its part into a compressed radix trie, whose
terminal nodes hold the owner (smallest or largest id) and the number of
rows.  Tasks first collapse what they read, so a text that fills a third of
the table crosses the network once per task.  A trie that outgrows its
budget writes its subtrees to the task's scratch folder and treats each by
itself at the end.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import struct
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import map_batches, prepare, task_folder

# Bytes of keys a trie holds before subtrees are spilled.
BUDGET = 96 << 20
# Rows of one output batch.
_OUT_ROWS = 2_000


def normalise(text: str | None) -> bytes:
    """UTF-8 of the text with A-Z lower-cased; null counts as empty."""
    return (text or "").encode().lower()


class Node:
    __slots__ = ("label", "children", "owner", "count")

    def __init__(self, label: bytes):
        self.label = label          # bytes on the edge into this node
        self.children: dict[int, Node] = {}
        self.owner: int | None = None
        self.count = 0              # rows that end here; 0: not terminal


class PatriciaTrie:
    """Compressed radix trie of byte strings with (owner, count) terminals."""

    def __init__(self, better: Callable[[int, int], int], budget: int = BUDGET):
        self.better, self.budget = better, budget
        self.root = Node(b"")
        self.held = 0
        self.spilled: dict[int, object] = {}  # first byte of a subtree -> scratch file

    def insert(self, key: bytes, owner: int, count: int) -> None:
        if key and key[0] in self.spilled:
            pickle.dump((key, owner, count), self.spilled[key[0]])
            return
        node, at = self.root, 0
        while True:
            if at == len(key):
                self._settle(node, owner, count)
                return
            child = node.children.get(key[at])
            if child is None:
                leaf = Node(key[at:])
                node.children[key[at]] = leaf
                self.held += len(leaf.label) + 200
                self._settle(leaf, owner, count)
                if self.held > self.budget:
                    self._spill()
                return
            label = child.label
            if not key.startswith(label, at):
                self._split(node, child, _shared(key, at, label))
                child = node.children[key[at]]
                label = child.label
            node, at = child, at + len(label)

    def _split(self, parent: Node, child: Node, n: int) -> None:
        """Put a node after the first n bytes of the edge to ``child``."""
        middle = Node(child.label[:n])
        parent.children[middle.label[0]] = middle
        child.label = child.label[n:]
        middle.children[child.label[0]] = child
        self.held += 200

    def _settle(self, node: Node, owner: int, count: int) -> None:
        node.owner = owner if not node.count else self.better(node.owner, owner)
        node.count += count

    def _spill(self) -> None:
        """Write every subtree of the root to its own scratch file; later keys
        of that subtree follow it there."""
        for first, child in list(self.root.children.items()):
            if len(self.root.children) == 1 and not self.spilled and not child.children:
                break  # one string: nothing to gain
            f = tempfile.TemporaryFile(dir=_scratch())
            for item in _walk(child, b""):
                pickle.dump(item, f)
            self.spilled[first] = f
            del self.root.children[first]
        self.held = sum(len(c.label) for c in self.root.children.values())

    def items(self) -> Iterator[tuple[bytes, int, int]]:
        yield from _walk(self.root, b"")
        for first in sorted(self.spilled):
            f = self.spilled[first]
            f.seek(0)
            yield from _regrow(f, self.better, self.budget, 1)
            f.close()


def _scratch() -> str:
    folder = task_folder()
    return folder if os.path.isdir(folder) else tempfile.gettempdir()


def _regrow(f, better, budget: int, depth: int) -> Iterator[tuple[bytes, int, int]]:
    """A spilled subtree as a trie of its own.  Keys are dealt by a hash into
    parts while it is larger than the budget: equal keys meet in one part."""
    size = f.seek(0, os.SEEK_END)
    f.seek(0)
    n = 1 if depth > 6 else max(1, -(-2 * size // budget))
    if n == 1:
        trie = PatriciaTrie(better, budget=1 << 62)
        for item in _load(f):
            trie.insert(*item)
        yield from _walk(trie.root, b"")
        return
    parts = [tempfile.TemporaryFile(dir=_scratch()) for _ in range(n)]
    for item in _load(f):
        h = hashlib.blake2b(item[0], digest_size=8, key=struct.pack("<I", depth)).digest()
        pickle.dump(item, parts[int.from_bytes(h, "little") % n])
    for part in parts:
        yield from _regrow(part, better, budget, depth + 1)
        part.close()


def _load(f) -> Iterator[tuple[bytes, int, int]]:
    while True:
        try:
            yield pickle.load(f)
        except EOFError:
            return


def _shared(key: bytes, at: int, label: bytes) -> int:
    """Length of the common start of key[at:] and label, by halving."""
    lo, hi = 0, min(len(label), len(key) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if key.startswith(label[:mid], at):
            lo = mid
        else:
            hi = mid - 1
    return lo


def _walk(node: Node, prefix: bytes) -> Iterator[tuple[bytes, int, int]]:
    stack = [(node, prefix)]
    while stack:
        node, prefix = stack.pop()
        whole = prefix + node.label
        if node.count:
            yield whole, node.owner, node.count
        stack.extend((c, whole) for c in node.children.values())


def exact_duplicates(docs: DataFrame, keep: str = "min", doc_id: str = "doc_id", text: str = "text",
                     budget: int = BUDGET) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) per input row.

    Texts are equal if identical after lower-casing A-Z; null counts as empty.
    Of equal texts the ``keep`` ("min" or "max") doc_id stays.  A row with a
    null id belongs to no group: keep_id null, group_size 1, kept.  Rows that
    repeat id and text are rows of one group, all kept if the id stays.  An
    empty table gives no rows; columns besides the two named are not read.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep must be 'min' or 'max'")
    better = min if keep == "min" else max
    prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [normalise(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(k) for k in keys], pa.int64()),
                 pa.array([hashlib.sha256(k).digest() for k in keys], pa.binary())],
                names=["doc_id", "length", "digest"])

    def out(items: Iterator[tuple[bytes, int, int]], whole: bool) -> Iterator[pa.RecordBatch]:
        part: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            length, digest, key, owner, count = zip(*part) if part else ((),) * 5
            names = ["length", "digest", *(["key"] if whole else []), "owner", "count"]
            arrays = [pa.array(length, pa.int64()), pa.array(digest, pa.binary()),
                      *([pa.array(key, pa.binary())] if whole else []),
                      pa.array(owner, pa.int64()), pa.array(count, pa.int64())]
            part.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for key, owner, count in items:
            part.append((len(key), hashlib.sha256(key).digest(), key, owner, count))
            held += len(key)
            if len(part) >= _OUT_ROWS or held > 8 << 20:
                yield batch()
                held = 0
        yield batch()

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(better, budget)
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                trie.insert(normalise(t), d, 1)
        yield from out(trie.items(), whole=True)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(better, budget)
        for b in batches:
            for key, owner, count in zip(*(b.column(i).to_pylist() for i in range(3))):
                trie.insert(key, owner, count)
        yield from out(trie.items(), whole=False)

    owners = map_batches(
        map_batches(rows.filter("doc_id is not null"), collapse,
                    "length long, digest binary, key binary, owner long, count long")
        .repartition("length", "digest").select("key", "owner", "count"),
        own, "length long, digest binary, owner long, count long")
    hashed = map_batches(rows, digests, "doc_id long, length long, digest binary")
    lookup = owners.select("length", "digest", "owner", "count")
    joined = hashed.withColumn("join_length", F.when(F.col("doc_id").isNotNull(), F.col("length"))).join(
        lookup.withColumnRenamed("length", "join_length"), ["join_length", "digest"], "left")
    return joined.select(
        "doc_id", F.col("owner").alias("keep_id"), F.coalesce("count", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("doc_id") == F.col("owner"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
