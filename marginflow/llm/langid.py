"""Language identification by compression.

A raw-content zstandard dictionary is cut for every language from labelled
text.  A text is compressed once with each dictionary, in chunks so that the
dictionary stays in reach of long texts, and gets the language whose
dictionary gives the smallest size.  Where the best two sizes are too close,
measured against the smallest, the prediction is rejected.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import map_batches, prepare

UNDETERMINED = "und"
# Fit: documents drawn per language (expected), code points of a drawn text
# from its first letter on, bytes of one dictionary.  A model of more than FULL_LANGUAGES
# languages keeps their bytes and documents in total: each gets a smaller share.
SAMPLE_DOCS = 160
SAMPLE_CHARS = 16_384
DICT_BYTES = 65_536
FULL_LANGUAGES = 256
# Scoring: chunk and zstandard level; a best size that wins by fewer than
# MIN_MARGIN bytes, or by less than its language's cut (a share of the best
# size), is a narrow margin.  The cut is CUT_SHARE of the CUT_QUANTILE of the
# clean margins, fitted on at most CUT_DOCS texts and CUT_SIZES compressions.
CHUNK_BYTES = 4_096
LEVEL = 5
MIN_MARGIN = 1
CUT_SHARE = 0.5
CUT_QUANTILE = 0.01
CUT_DOCS = 1024
CUT_SIZES = 1 << 18

_LETTER = regex.compile(r"\p{L}")
# Everything in ASCII but letters becomes a space: junk symbols, digits and
# layout say nothing about the language.
_FOLD = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def fold(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_FOLD).split())


class Model(dict):
    """Dictionaries by language, and the cut of each language that has one."""

    def __init__(self, *args):
        super().__init__(*args)
        self.cuts: dict[str, float] = {}


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS,
        dict_bytes: int = DICT_BYTES, max_languages: int | None = None) -> Model:
    """Dictionaries by language, most frequent language first, from a bounded
    sample of labelled rows.

    Rows with a null text or language are left out.  Twice ``sample_docs``
    distinct texts per language (expected; by a hash of the text, so reruns
    agree), at least one, reach the driver, which keeps ``dict_bytes`` of
    each language.  The rate counts distinct texts: copies neither crowd out
    a language nor fill its dictionary.  Texts of any length are drawn; of one
    over SAMPLE_CHARS code points, that many from its first letter on are used,
    and where texts are long, fewer are drawn, about 8 * ``dict_bytes`` code
    points per language.  All languages are learned: beyond FULL_LANGUAGES, documents and
    dictionary bytes are shared out, so that the model stays within
    FULL_LANGUAGES * ``dict_bytes``, and at least a byte of each language.  An
    empty table gives an empty model.  More than ``max_languages`` languages,
    if given, raise ValueError.  Drawn texts beyond the dictionaries set
    the cut of each language's relative margin.
    """
    rows = (labelled.select(F.col(text).alias("t"), F.col(lang).alias("l"))
            .filter(F.col("t").isNotNull() & F.col("l").isNotNull())
            .filter(F.col("t").rlike(r"\p{L}")))
    span = 1 << 40
    rows = rows.withColumn("hash", F.xxhash64("t")).withColumn("draw", F.pmod("hash", F.lit(span)))
    used = F.least(F.length("t"), F.lit(SAMPLE_CHARS)).cast("long")
    texts = rows.groupBy("l", "hash", "draw").agg(F.count("*").alias("n"), F.max(used).alias("chars"))
    counted = texts.groupBy("l").agg(
        F.sum("n").alias("rows"), F.count("*").alias("texts"), F.sum("chars").alias("chars"), F.min("draw").alias("first"))
    if max_languages is not None:
        counted = counted.limit(max_languages + 1)
    counts = {r["l"]: r for r in counted.collect()}
    if max_languages is not None and len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages in the labelled rows")
    if not counts:
        return Model()
    share = min(1.0, FULL_LANGUAGES / len(counts))
    dict_bytes = max(1, int(dict_bytes * share))
    cuts = []
    for name, r in counts.items():
        rate = min(2 * sample_docs * share / r["texts"], 8 * dict_bytes / r["chars"])
        cuts.append((name, min(span, max(r["first"] + 1, math.ceil(rate * span)))))
    cuts = labelled.sparkSession.createDataFrame(cuts, f"l {rows.schema['l'].dataType.simpleString()}, cut long")
    drawn = rows.join(F.broadcast(cuts), "l").filter("draw < cut")  # one row per language
    by_lang: dict[str, list[str]] = {}
    lead = F.when(F.length("t") > SAMPLE_CHARS, F.regexp_replace("t", r"^\P{L}+", "")).otherwise(F.col("t"))
    for r in drawn.select("l", F.substring(lead, 1, SAMPLE_CHARS).alias("t")).distinct().collect():
        by_lang.setdefault(r["l"], []).append(r["t"])
    model, spare = Model(), {}
    for name in sorted(by_lang, key=lambda x: (-counts[x]["rows"], x)):
        texts = sorted(by_lang[name], key=lambda x: (xxhash.xxh64_intdigest(x.encode()), x))
        folded = [fold(t) for t in texts]
        model[name] = b" ".join(folded)[:dict_bytes]
        ends = itertools.accumulate(len(f) + 1 for f in folded)
        spare[name] = [t for t, f, end in zip(texts, folded, ends) if end - len(f) - 1 >= dict_bytes]
    model.cuts = _fit_cuts(model, spare)
    return model


def _fit_cuts(model: Model, spare: dict[str, list[str]]) -> dict[str, float]:
    """Cuts of the languages from labelled texts that are in no dictionary; a
    language without such a text gets none."""
    each = max(1, min(CUT_DOCS, CUT_SIZES // len(model)) // len(model))
    texts = [(name, t) for name, own in spare.items() for t in own[:each]][:max(1, CUT_SIZES // len(model))]
    margins: dict[str, list[float]] = {}
    for (name, _), (found, _, _, rejected, share) in zip(texts, Classifier(model).measure([t for _, t in texts])):
        if found == name and not rejected:
            margins.setdefault(name, []).append(share)
    return {name: CUT_SHARE * sorted(m)[int(CUT_QUANTILE * len(m))] for name, m in margins.items()}


class Classifier:
    """Compressors of one fitted model; built once per task, or, of more than
    ``group`` languages, group by group for every batch."""

    def __init__(self, model: dict[str, bytes], level: int = LEVEL, chunk: int = CHUNK_BYTES,
                 group: int = FULL_LANGUAGES):
        self.level, self.chunk = level, chunk
        self.cuts = getattr(model, "cuts", {})
        ranked = [(i, name, content) for i, (name, content) in enumerate(model.items())]
        self.groups = [ranked[i:i + group] for i in range(0, len(ranked), group)]
        self.coders = self._coders(self.groups[0]) if len(self.groups) == 1 else []

    def _coders(self, group: list[tuple[int, str, bytes]]) -> list[tuple[int, str, zstandard.ZstdCompressor]]:
        coders = []
        for i, name, content in group:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            p = zstandard.ZstdCompressionParameters.from_level(
                self.level, source_size=self.chunk, dict_size=len(content), min_match=3,
                write_content_size=False, write_checksum=False, write_dict_id=False)
            d.precompute_compress(compression_params=p)
            coders.append((i, name, zstandard.ZstdCompressor(dict_data=d, compression_params=p)))
        return coders

    def sizes(self, folded: bytes, coders: list) -> list[tuple[int, int, str]]:
        """(compressed bytes, rank of the language, language), smallest first."""
        chunks = [folded[i:i + self.chunk] for i in range(0, len(folded), self.chunk)]
        return sorted((sum(len(c.compress(x)) for x in chunks), i, name) for i, name, c in coders)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, int, bool]]:
        """Language, score, margin in bytes, rejected."""
        return [p[:4] for p in self.measure(texts)]

    def measure(self, texts: list[str | None]) -> list[tuple[str, float, int, bool, float]]:
        """``predict``, and the margin as a share of the best size."""
        out = [(UNDETERMINED, 0.0, 0, True, 0.0)] * len(texts)
        if not self.groups:
            return out
        # per text: best two sizes so far, sum of 2 ** (best - size)
        found: dict[int, tuple[list[tuple[int, int, str]], float]] = {}
        usable = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)]
        for group in self.groups:
            coders = self.coders or self._coders(group)
            for i in usable:
                here = self.sizes(fold(texts[i]), coders)
                best = here[0][0]
                # A byte more is a factor of two: chunk headers make the sizes coarse.
                weight = sum(2.0 ** -min(s - best, 1000) for s, _, _ in here)
                if i in found:
                    before, w = found[i]
                    here = sorted(before + here[:2])
                    low = here[0][0]
                    weight = (weight * 2.0 ** -min(best - low, 1000)
                              + w * 2.0 ** -min(before[0][0] - low, 1000))
                found[i] = here[:2], weight
        for i, (sizes, weight) in found.items():
            best = sizes[0][0]
            margin = (sizes[1][0] if len(sizes) > 1 else best + len(fold(texts[i]))) - best
            share, name = margin / max(1, best), sizes[0][2]
            out[i] = name, 1.0 / weight, margin, margin < MIN_MARGIN or share < self.cuts.get(name, 0.0), share
        return out


def identify(docs: DataFrame, model: dict[str, bytes], keep: list[Column], keep_schema: str,
             text: str = "text") -> DataFrame:
    """One row per input row: the ``keep`` columns, then lang_pred, score,
    margin_bytes and rejected.

    A null text, or one without a letter, gives ``und``, score 0, rejected.
    An empty model gives ``und`` for every row.  Ties go to the
    language that is most frequent in training and are rejected (margin 0), as is
    a margin that is a smaller share of the best size than the language's cut.  Only the text
    is an input of the prediction; whole texts are read, in chunks.
    """
    prepare(docs.sparkSession)
    n_keep = len(keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most FULL_LANGUAGES * DICT_BYTES and names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for b in batches:
            out = classifier.predict(b.column(n_keep).to_pylist())
            lang, score, margin, rejected = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n_keep], pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(margin, pa.int64()), pa.array(rejected, pa.bool_())],
                names=[*b.schema.names[:n_keep], "lang_pred", "score", "margin_bytes", "rejected"])

    return map_batches(docs.select(*keep, F.col(text).alias("__text")), run,
                       f"{keep_schema}, lang_pred string, score double, margin_bytes long, rejected boolean")
