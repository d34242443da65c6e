"""Benchmark decontamination, in DataFrame functions only.

The benchmark's windows of ``window`` normalised words (an item with fewer
words is one window) become a set of 64-bit hashes.  One scan of the documents
hashes the window at every word and probes the broadcast set; what it finds is
verified word by word against the windows, so a hash collision marks nothing.
A verified window marks all its words in the document, overlaps once.

The broadcast set holds at most ``SET_HASHES`` hashes.  A larger benchmark is
taken in blocks of that size, one scan each.  Documents are never grouped or
joined by text: a document is a row number given by the scan that writes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginflow.llm.common import prepare, written

WINDOW = 10
# Hashes in one broadcast set (about 40 bytes each on an executor).
SET_HASHES = 1_000_000
# Characters that are in no word, in lower-case and in any text.
BETWEEN = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
BETWEEN_CASED = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Normalised words: A-Z in lower case, then runs of 0-9, a-z and everything
    beyond U+007F; null has none.  Split, not extracted: extracting all matches
    copies the text for each of them.  ``lower`` is used where all is ASCII."""
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), f"[{BETWEEN}]+"), "")


def benchmark_windows(items: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, length, phrase, hash) of every window of every item, once."""
    words = items.select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("words")).filter("size(words) > 0")
    # the words of one item at a time: items are short texts
    return (words.withColumn("length", F.least(F.size("words"), F.lit(window)))
            .select("item_id", "length", "words",
                    F.explode(F.sequence(F.lit(1), F.expr("size(words) - length + 1"))).alias("at"))
            .select("item_id", "length", F.array_join(F.slice("words", F.col("at"), F.col("length")), " ").alias("phrase"),
                    _hash("words", F.col("at") - 1, F.col("length"), window).alias("hash"))
            .distinct())


def _hash(words: str, at: Column, length: Column | int, window: int) -> Column:
    """Hash of ``length`` (at most ``window``) words from the 0-based ``at``."""
    n = F.lit(length) if isinstance(length, int) else length
    return F.xxhash64(n, *[F.when(n > i, F.get(F.col(words), at + i)) for i in range(window)])


def _found(base: DataFrame, hashes: DataFrame, lengths: list[int], window: int) -> DataFrame:
    """One scan: (row, length, at, phrase) of the windows whose hash is in
    ``hashes`` (broadcast), and once per row (length null) its n_words."""
    each = F.explode(F.array(*[F.lit(n) for n in lengths]))
    at = (base.select("row", "words", F.size("words").alias("n_words"), F.posexplode_outer("words"))
          .select("row", "words", "n_words", F.col("pos").alias("at")))
    if lengths != [window]:
        at = at.select("*", each.alias("length"))
        own = _hash("words", F.col("at"), F.col("length"), window)
    else:
        at = at.withColumn("length", F.lit(window))
        own = F.xxhash64(F.lit(window), *[F.get(F.col("words"), F.col("at") + i) for i in range(window)])
    at = at.withColumn("hash", F.when(F.col("at") + F.col("length") <= F.col("n_words"), own))
    hit = at.join(F.broadcast(hashes.select("hash", F.lit(True).alias("hit"))), "hash", "left")
    first = (F.coalesce("at", F.lit(0)) == 0) & (F.col("length") == lengths[0])
    return (hit.filter(F.col("hit") | first)
            .select("row", "n_words", first.alias("first"), F.coalesce("hit", F.lit(False)).alias("hit"), "length", "at",
                    F.when(F.col("hit"), F.array_join(F.slice("words", F.col("at") + 1, F.col("length")), " ")).alias("phrase")))


def _marked(base: DataFrame, items: DataFrame, window: int, item_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Of ``base`` (row, words): documents (row, n_words) and the verified
    windows (row, at, length, item_id).  With one block the scan of ``base``
    that finds the windows also writes its row numbers; with more, ``base`` is
    written first.
    """
    windows = written(benchmark_windows(items, window, item_id, text), "benchmark-windows")
    hashes = windows.select("hash", "length").distinct()
    n_hashes = hashes.count()
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect()) or [window]
    blocks = max(1, -(-n_hashes // SET_HASHES))
    if blocks > 1:
        base = written(base, "documents")
    found = None
    for b in range(blocks):
        part = hashes if blocks == 1 else hashes.filter(F.pmod(F.xxhash64("hash"), F.lit(blocks)) == b)
        one = _found(base, part.select("hash").distinct(), lengths, window)
        if b:
            one = one.withColumn("first", F.lit(False)).filter("hit")
        found = one if found is None else found.unionByName(one)
    found = written(found, "found-windows")
    hits = written(found.filter("hit").join(windows, ["phrase", "length"]).select("row", "at", "length", "item_id"), "hits")
    return found.filter("first").select("row", "n_words"), hits


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per input row.

    n_hit counts the words inside any occurrence of a benchmark window, each
    once; n_items the items with an occurring window; items_sha256 is the
    SHA-256 of their ids, sorted as strings and comma-joined (of the empty
    string without any).  Null and empty texts have no words and are clean.
    Items without words occur nowhere; an item without an id marks words but is
    not counted; rows that repeat an item id are one item.  Every document row
    is judged for itself, whatever its id (null and repeated ids, too).
    Without items all is clean; an empty table gives no rows; other columns are
    not read.
    """
    prepare(docs.sparkSession)
    # the id is written beside its row number by the scan that gives the numbers
    base = docs.select(F.monotonically_increasing_id().alias("number"), F.col(doc_id).alias("doc_id"),
                       words_of(F.col(text)).alias("words"))
    base = base.select(F.struct("number", "doc_id").alias("row"), "words")
    rows, hits = _marked(base, items, window, item_id, item_text)
    rows = rows.select("row.number", "row.doc_id", "n_words")
    hits = hits.select("row.number", "at", "length", "item_id")
    spans = merged_spans(hits).groupBy("number").agg(F.sum(F.col("stop") - F.col("start")).alias("n_hit"))
    listed = (hits.filter("item_id is not null").select("number", F.col("item_id").cast("string").alias("item")).distinct()
              .groupBy("number").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items")))
    # written: a join straight to an aggregate could not split
    found = written(spans.join(listed, "number", "left"), "contaminated")
    return (rows.join(found, "number", "left")
            .select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce("items", F.lit("")).cast("binary"), 256).alias("items_sha256"),
                    F.col("n_hit").isNotNull().alias("contaminated")))


def merged_spans(hits: DataFrame) -> DataFrame:
    """(number, start, stop): the words that hits (number, at, length) cover,
    as spans that do not overlap.  A document's hits are at most its words."""
    longest = hits.groupBy("number", "at").agg(F.max("length").alias("length"))
    by = Window.partitionBy("number").orderBy("at")
    before = F.max(F.col("at") + F.col("length")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    return (longest.withColumn("reached", F.coalesce(before, F.lit(0)))
            .select("number", F.greatest("at", "reached").alias("start"), (F.col("at") + F.col("length")).alias("stop"))
            .filter("stop > start"))


def remove_contaminated(docs: DataFrame, items: DataFrame, how: str = "spans", window: int = WINDOW, text: str = "text",
                        item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` (same columns) without what the benchmark holds.

    ``how="documents"`` drops every row with a hit word.  ``how="spans"`` keeps
    all rows and takes the hit words out of their texts, each with the
    characters between it and the word before.  Clean texts, and null ones,
    stay as they are.
    """
    if how not in ("spans", "documents"):
        raise ValueError(f"how must be 'spans' or 'documents', not {how!r}")
    prepare(docs.sparkSession)
    # rows travel whole in one struct, so no column can clash with ours
    base = written(docs.select(F.monotonically_increasing_id().alias("number"), F.col(text).alias("body"),
                               F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")), "numbered")
    scanned = base.select(F.struct("number").alias("row"), words_of(F.col("body")).alias("words"))
    _, hits = _marked(scanned, items, window, item_id, item_text)
    spans = merged_spans(hits.select("row.number", "at", "length"))
    per_row = written(spans.groupBy("number").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "spans")
    if how == "documents":
        return base.join(per_row, "number", "left_anti").select("whole.*")
    # cut after every word; what follows the last one is a piece of its own
    pieces = F.split("body", f"(?<=[^{BETWEEN_CASED}])(?=[{BETWEEN_CASED}])")
    kept = F.filter(pieces, lambda _, i: ~F.exists("spans", lambda s: (s["start"] <= i) & (i < s["stop"])))
    clean = F.when(F.col("spans").isNull(), F.col("body")).otherwise(F.array_join(kept, ""))
    joined = base.join(per_row, "number", "left").withColumn("body", clean)
    return joined.select(*[F.col("body").alias(c) if c == text else F.col(f"whole.`{c}`") for c in docs.columns])
