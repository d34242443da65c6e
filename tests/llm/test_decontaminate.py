"""Benchmark decontamination against brute force on small tables."""

import hashlib
import re

import pytest

from marginflow.llm import decontaminate
from marginflow.llm.queries import QUERIES
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, row long, number long, words string, phrase string, hash long, whole string, body string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    """Per (doc_id, text): n_words, hit word numbers, items."""
    wanted = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            wanted.setdefault(tuple(w[a:a + n]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in wanted}:
            for a in range(len(w) - n + 1):
                if (k := tuple(w[a:a + n])) in wanted:
                    hit |= set(range(a, a + n))
                    found |= wanted[k]
        listed = sorted(str(x) for x in found - {None})
        out.append((i, len(w), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return out


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, 2, "w", "p", 3, "x", "b") for i, t in docs], DOCS),
            spark.createDataFrame([(i, t, "p") for i, t in items], "item_id long, text string, phrase string"))


LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
ITEM = "The quick brown fox jumps over the lazy dog while Ñandú ÉL counts 12 eggs"
ITEMS = [(1, ITEM), (12, "  the QUICK, brown-fox jumps over the lazy dog: while ñandú"), (2, "short question? yes"),
         (3, None), (4, "...!"), (None, "an item without any id that has more than ten words in it"),
         (5, " ".join(LONG.split()[20_000:20_015])), (5, "the same id once more with another text of more than ten words"),
         (1, ITEM), (7, "a a a a a a a a a a a a")]
DOCUMENTS = [
    (1, f"Before. {ITEM.lower()}! After"), (1, f"Before. {ITEM}! After"), (1, f"Before. {ITEM}! After"),
    (None, f"x {ITEM} y"), (None, None), (2, None), (3, ""), (4, "?! -- \n"), (5, "clean text of some words"),
    (6, "Short question\nYES and short question yes"), (7, LONG), (8, "An item without any id that has more than ten words in it."),
    (9, " ".join(["a"] * 500)), (10, "a a a a a a a a a"), (11, "the quick brown fox jumps over the lazy dog while"),
    (12, "The same id once more with another text of more than ten words, the quick brown fox jumps over the lazy dog while ñandú él"),
    *[(100 + i, f"copy {ITEM}") for i in range(300)]]


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


@pytest.mark.parametrize("hashes", [decontaminate.SET_HASHES, 7])
def test_odd_rows_match_brute_force(spark, monkeypatch, hashes):
    """Null, empty, long, repeated and clashing; also with a set taken in blocks."""
    monkeypatch.setattr(decontaminate, "SET_HASHES", hashes)
    docs, items = frames(spark, DOCUMENTS, ITEMS)
    assert rows_of(decontaminate.contamination(docs, items)) == sorted(brute(DOCUMENTS, ITEMS), key=str)


def test_empty_tables(spark):
    docs, items = frames(spark, DOCUMENTS, ITEMS)
    assert rows_of(decontaminate.contamination(docs.limit(0), items)) == []
    clean = rows_of(decontaminate.contamination(docs, items.limit(0)))
    assert clean == sorted(brute(DOCUMENTS, []), key=str) and not any(r[-1] for r in clean)
    assert decontaminate.remove_contaminated(docs, items.limit(0)).count() == len(DOCUMENTS)


def test_a_colliding_hash_marks_nothing(spark, monkeypatch):
    """With one hash for all windows, verification alone decides."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(decontaminate.F, "xxhash64", lambda *c: F.lit(1).cast("long") + F.octet_length(F.lit("")))
    docs, items = frames(spark, DOCUMENTS[:6] + DOCUMENTS[-2:], ITEMS[:1])
    assert rows_of(decontaminate.contamination(docs, items)) == sorted(brute(DOCUMENTS[:6] + DOCUMENTS[-2:], ITEMS[:1]), key=str)


def test_spans_and_documents_are_removed(spark):
    docs, items = frames(spark, DOCUMENTS, ITEMS)
    want = brute(DOCUMENTS, ITEMS)
    left = decontaminate.remove_contaminated(docs, items, "documents")
    assert left.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in left.collect()))) == sorted(
        str(d) for d, w in zip(DOCUMENTS, want) if not w[-1])
    spans = decontaminate.remove_contaminated(docs, items)
    assert spans.columns == docs.columns
    got = [(r.doc_id, r.text) for r in spans.collect()]
    assert len(got) == len(DOCUMENTS)
    assert (1, "Before! After") in got and (None, "x y") in got and (6, " and") in got
    for d, w in zip(DOCUMENTS, want):
        if not w[-1]:
            assert d in got
    sizes = sorted((str(i), len(words(t))) for i, t in got)
    assert sizes == sorted((str(w[0]), w[1] - w[2]) for w in want)


def test_plan_is_native(spark):
    docs, items = frames(spark, DOCUMENTS, ITEMS)
    plan = decontaminate.contamination(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query_matches_brute_force(spark):
    read = lambda t, c: [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/{t}.parquet").select(*c).collect()]
    want = brute(read("documents", ["doc_id", "text"]), read("benchmark", ["item_id", "text"]))
    got = rows_of(QUERIES["op12_decontaminate"](spark, SF_SMALL))
    assert got == sorted(want, key=str) and sum(r[-1] for r in got) > 0
