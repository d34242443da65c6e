"""Operators that treat each document by itself: language, tokens, quality,
toxicity.  Brute force, round trips and held-out accuracy."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import public_tokenizers as P
from marginflow.llm import langid, quality, tokens, toxicity
from marginflow.llm.queries import QUERIES
from tests.conftest import SF_CHECK

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, unit string, n long"
LONG = "The quick brown fox jumps over the lazy dog. " * 8000


def frame(spark, texts):
    rows = [(i if i != 3 else None, t, None, None, None, 0.5, "u", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def identified(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, 0.5, "u", 1) for i, t in rows], DOCS)


ODD = ["plain words here.", None, "", "null id row", " \n\t ", "1234 #### 5678", "tie", "tie", LONG, "x" * 200_000,
       "a  b   c \n d", "ends with space ", "<|endoftext|> inside a<|endoftext|>b  <|endoftext|>", "nul\x00byte here",
       "emoji 😀 ümläut 日本語 　 wide"]


@pytest.fixture(scope="module")
def bpe():
    return tokens.tokenizer(P.path("byte_bpe_50k.json"))[0]


def test_token_counts_equal_the_library(spark, bpe):
    df = frame(spark, ODD)
    out = tokens.count_tokens(df, P.path("byte_bpe_50k.json"), head=5)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in out.collect())
    want = sorted((i == 3, 0 if i == 3 else i, len((t or "").encode()), len(bpe.encode(t or "", add_special_tokens=False).ids))
                  for i, t in enumerate(ODD))
    assert got == want
    assert tokens.count_tokens(df.limit(0), P.path("byte_bpe_50k.json")).count() == 0


def test_token_counts_without_a_head(spark, bpe):
    df = frame(spark, ODD)
    a = tokens.count_tokens(df, P.path("byte_bpe_50k.json"), head=0)
    b = tokens.count_tokens(df, P.path("byte_bpe_50k.json"))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list(" \n\t\x0b\x1c\x85\xa0'sdlretvm.,!1a é")), st.characters(exclude_categories=["Cs"])),
               max_size=40))
def test_units_cut_where_the_tokenizer_cuts(text):
    path = P.path("byte_bpe_50k.json")
    t, special = tokens.tokenizer(path)
    keys, whole = tokens.units(text, special)
    strings = [k[1:] if k[0] == "\x00" else " " + k for k in keys] + whole
    assert sum(tokens.n_pieces(strings, path)) == len(t.encode(text, add_special_tokens=False).ids)


def test_token_query_is_exact_on_the_table(spark, bpe):
    rows = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: len(e.ids) for r, e in zip(rows, bpe.encode_batch([r.text or "" for r in rows], add_special_tokens=False))}
    got = {r.doc_id: (r.n_tokens, r.over_limit) for r in QUERIES["op2_token_counts"](spark, SF_CHECK).collect()}
    assert got == {k: (v, v > 1024) for k, v in want.items()}


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang")
    out = QUERIES["op1_langid"](spark, SF_CHECK)
    assert out.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = out.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark):
    labelled = spark.createDataFrame([("the cat sat on the mat with the dog " * 5, "en"),
                                      ("der hund und die katze sind nicht im haus " * 5, "de"),
                                      ("the house is on the hill " * 5, "en"), (None, "en"), ("???", "xx"),
                                      ("ohne sprache", None)], "text string, lang string")
    model = langid.fit(labelled)
    assert list(model) == ["en", "de"]
    keep = [F.col("doc_id"), F.col("score").alias("other")]
    out = langid.identify(frame(spark, ODD), model, keep, "doc_id long, other double").collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(ODD)
    for i in (1, 2, 4, 5):
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True)
    assert by[8].lang_pred == "en" and not by[8].rejected
    assert by[6].lang_pred == by[7].lang_pred
    assert langid.fit(labelled.limit(0)) == {}
    assert {r.lang_pred for r in langid.identify(frame(spark, ODD), {}, keep, "doc_id long, other double").collect()} == {"und"}
    with pytest.raises(ValueError, match="languages"):
        langid.fit(labelled, max_languages=1)


def test_language_of_many_copies_is_learned(spark):
    """100,000 rows that are copies of 5 texts beside a language of 400 texts."""
    copies = spark.range(100_000).select(
        F.concat(F.lit("der hund und die katze sind nicht im haus nummer "), (F.col("id") % 5).cast("string")).alias("text"),
        F.lit("de").alias("lang"))
    single = spark.range(400).select(
        F.concat(F.lit("the cat sat on the mat with the dog number "), F.col("id").cast("string")).alias("text"),
        F.lit("en").alias("lang"))
    model = langid.fit(copies.unionByName(single))
    assert list(model) == ["de", "en"]
    assert model["de"].count(b"katze") == 5 and model["en"].count(b"mat") > 200
    one = langid.fit(copies.unionByName(single), sample_docs=1e-6)
    assert list(one) == ["de", "en"] and all(one.values())


def test_more_languages_than_full_dictionaries(spark, monkeypatch):
    monkeypatch.setattr(langid, "FULL_LANGUAGES", 40)
    syllable = ["ka", "lo", "mi", "tu", "re", "sa", "no"]
    word = lambda i: "".join(syllable[(i // 7 ** k) % 7] for k in range(4))
    rows = [(f"{word(i * 8 + 1)} {word(i * 8 + 5)} {word(i * 8 + 3)} " * 9 + "x" * j, f"l{i}") for i in range(300) for j in range(4)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"), dict_bytes=3000)
    assert len(model) == 300 and sum(map(len, model.values())) <= 40 * 3000 and all(model.values())
    texts = [rows[4 * i][0] for i in range(0, 300, 7)] + [None, ""]
    split = langid.Classifier(model, group=40).predict(texts)
    assert split == langid.Classifier(model, group=300).predict(texts)
    assert [p[0] for p in split[:-2]] == [f"l{i}" for i in range(0, 300, 7)]


def test_language_of_long_texts_only_is_learned(spark):
    long = "1234 " * 5_000 + "der hund und die katze sind nicht im haus " * 2_000
    rows = [(long, "de"), ("the cat sat on the mat with the dog " * 5, "en"), ("the house is on the hill " * 5, "en")]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert list(model) == ["en", "de"]
    assert model["de"].startswith(b"der hund") and len(model["de"]) <= langid.SAMPLE_CHARS
    assert langid.Classifier(model).predict(["die katze ist im haus und der hund nicht"])[0][0] == "de"
    many = [(f"{chr(97 + i % 26)}{chr(97 + i // 26)} " + "das haus am see " * 1_500, "de") for i in range(400)]
    model = langid.fit(spark.createDataFrame(many, "text string, lang string"))
    assert len(model["de"]) == langid.DICT_BYTES


def test_language_that_was_not_learned_is_rejected(spark):
    """Long French texts win by a few bytes in 1,000 only; clean ones stay."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").filter(F.length("text") > 300).select("text", "lang")
    model = langid.fit(docs.filter("lang <> 'fr' and crc32(text) % 4 <> 2"))
    rows = docs.filter("crc32(text) % 4 = 2").collect()
    gone = lambda lang: [p[3] for p in langid.Classifier(model).predict([r.text for r in rows if (r.lang == "fr") == lang][:200])]
    strange, clean = gone(True), gone(False)
    assert len(strange) > 20 and sum(strange) > 0.7 * len(strange)
    assert sum(clean) < 0.02 * len(clean)


def test_quality_agrees_with_labels(spark):
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    out = QUERIES["op4_quality"](spark, SF_CHECK)
    assert out.count() == spark.read.parquet(f"{SF_CHECK}/documents.parquet").count()
    rows = out.join(labels, "doc_id").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.93
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.93


def test_quality_sample_counts_a_text_once(spark, monkeypatch):
    """40,000 copies of one text beside 100 texts, asked for 60: all of them
    would be drawn too rarely by rows, and copies would reach the driver."""
    copies = spark.range(40_000).select(F.lit("a large group of copies of this text").alias("text"))
    df = copies.unionByName(spark.range(100).select(F.concat(F.lit("plain words number "), F.col("id").cast("string")).alias("text")))
    used, scorer, collect = [], quality._fit_scorer, type(df).collect
    monkeypatch.setattr(quality, "_fit_scorer", lambda own, target: used.append(len(own)) or scorer(own, target))
    sent = []
    monkeypatch.setattr(type(df), "collect", lambda self: sent.append(collect(self)) or sent[-1])
    quality.fit(df, sample_docs=60)
    assert 30 < used[0] < 90
    quality.fit(df, sample_docs=100_000)
    assert used[1] == 101 and max(map(len, sent)) == 101


LONG_WORDS = "the cat sat on a mat and then it went to see some old friends by the river while they were at home".split()


def long_text(rng, n, extra=()):
    words = [rng.choice(LONG_WORDS) for _ in range(n)]
    for w in extra:
        words[rng.randrange(n)] = w
    return " ".join(w + ("." if k % 12 == 11 else "") for k, w in enumerate(words))


def test_quality_of_long_texts_only(spark):
    """Where every text is over 16,384 code points the scorer learns from them."""
    rng = random.Random(8)
    good = [(i, long_text(rng, 4500)) for i in range(30)]
    bad = [(100 + i, " ".join(rng.choice(["###", "@@", "$$$", "WIN", "CLICK", "<>"]) for _ in range(6000))) for i in range(30)]
    df = identified(spark, good + bad)
    assert min(len(t) for _, t in good + bad) > 16_384
    model = quality.fit(df)
    assert np.abs(model["scorer"]["words"]).max() > 0
    score = {r.doc_id: r.score for r in quality.score(df, model, [F.col("doc_id")], "doc_id long").collect()}
    assert min(score[i] for i, _ in good) > max(score[i] for i, _ in bad)


def test_quality_sample_is_bounded_by_code_points(spark, monkeypatch):
    rng = random.Random(9)
    df = identified(spark, [(i, long_text(rng, 2000)) for i in range(80)])
    monkeypatch.setattr(quality, "SLICE_CHARS", 3_000)
    monkeypatch.setattr(quality, "SAMPLE_CHARS", 60_000)
    used, scorer = [], quality._fit_scorer
    monkeypatch.setattr(quality, "_fit_scorer", lambda own, target: used.extend(own) or scorer(own, target))
    quality.fit(df)
    assert 5 < len(used) < 45 and max(map(len, used)) == 3_000


def test_toxicity_of_long_texts_only(spark):
    """Labelled texts over 16,384 code points give a model and differing scores."""
    rng = random.Random(11)
    toxic = [f"vile{k}" for k in range(5)]
    rows = [(i, long_text(rng, 4500, [rng.choice(toxic) for _ in range(60)] if i % 3 == 0 else ())) for i in range(120)]
    assert min(len(t) for _, t in rows) > 16_384
    df = identified(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    score = {r.doc_id: r.score for r in toxicity.score(df, model, [F.col("doc_id")], "doc_id long").collect()}
    held = range(90, 120)
    assert min(score[i] for i in held if i % 3 == 0) > max(score[i] for i in held if i % 3)


def test_toxicity_sample_is_bounded_by_code_points(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(i, long_text(rng, 1500, ["vile"] * 20 if i % 2 else ())) for i in range(60)]
    monkeypatch.setattr(toxicity, "SLICE_CHARS", 2_000)
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 20_000)
    seen, words = [], toxicity.words_of
    monkeypatch.setattr(toxicity, "words_of", lambda t: seen.append(len(t)) or words(t))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    assert toxicity.fit(identified(spark, rows), labels) is not None
    assert max(seen) <= 2_000 and 12 <= len(seen) <= 20


def test_estimated_accuracies_follow_the_labellers():
    """EM on votes of simulated labellers ranks a reliable above a weak one."""
    rng = np.random.default_rng(3)
    k = len(quality.LABELLERS)
    truth = rng.random(20_000) < 0.8
    right = np.array([0.95] * (k - 1) + [0.6])
    votes = np.where(rng.random((len(truth), k)) < right, truth[:, None], ~truth[:, None]) * 2
    keys = (votes * 3 ** np.arange(k - 1, -1, -1)).sum(axis=1)
    patterns = dict(zip(*map(lambda a: a.tolist(), np.unique(keys, return_counts=True))))
    model = quality.estimate(patterns)
    assert abs(model["prior"] - 0.8) < 0.02
    assert abs(model["votes"][1, 0, 2] - 0.95) < 0.02 and abs(model["votes"][1, k - 1, 2] - 0.6) < 0.03


def test_quality_of_odd_texts(spark):
    df = frame(spark, ODD)
    model = quality.fit(df)
    rows = quality.score(df, model, [F.col("doc_id"), F.col("n")], "doc_id long, n long").collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and 0 <= r.weak_label <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[1] == by[2] and by[6] == by[7]
    assert quality.fit(df.limit(0)) is None
    assert quality.score(df.limit(0), None, [F.col("doc_id")], "doc_id long").count() == 0


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    out = QUERIES["op8_toxicity"](spark, SF_CHECK)
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").join(docs.select("doc_id", "text", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    toxic = [r.score for r in held if r.toxic == 1]
    clean = [r.score for r in held if r.toxic == 0]
    # 37 toxic training rows, few of them in other languages than English
    assert sum(a > b for a in toxic for b in clean) / (len(toxic) * len(clean)) > 0.78
    english = [r for r in held if r.lang == "en"]
    assert sum(r.predicted == r.toxic for r in english) / len(english) > 0.93
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    spans = [(r.text[s.start:s.end], s.marginal) for r in rows if r.toxic for s in r.spans]
    assert spans and all(w.isalpha() and m >= 0.5 for w, m in spans)


def test_forward_backward_equals_enumeration():
    """Marginals of short chains against all tag sequences."""
    import itertools

    rng = np.random.default_rng(5)
    lengths = np.array([3, 0, 5, 1], np.int64)
    emit = rng.normal(size=int(lengths.sum()))
    trans = np.exp(rng.normal(size=(2, 2)))
    layout = toxicity.Layout(lengths)
    place = layout.place()
    odds = np.empty(len(place))
    odds[place] = np.exp(emit)
    alpha, beta = toxicity.forward_backward(odds, layout, trans)
    p = (alpha * beta / (1 + alpha * beta))[place]
    at = 0
    for n in lengths:
        e = emit[at:at + n]
        total, mass = 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(e[i] for i in range(n) if tags[i])) * np.prod([trans[a, b] for a, b in zip(tags, tags[1:])])
            total += w
            mass += w * np.array(tags)
        assert np.allclose(p[at:at + n], mass / total)
        at += n


def test_toxicity_of_odd_texts(spark):
    rows = [(i, f"what a {'scumbag' if i % 2 else 'friend'} he is and more words follow here {i}", i % 2) for i in range(200)]
    labelled = spark.createDataFrame([*rows, (200, None, 1), (201, "no label", None), (None, "no id", 1)],
                                     "doc_id long, text string, toxic int")
    notes, labels = labelled.select("doc_id", "text"), labelled.select("doc_id", "toxic")
    model = toxicity.fit(notes, labels)
    texts = [*ODD, "what a SCUMBAG he is"]
    df = frame(spark, texts)
    out = toxicity.score(df, model, [F.col("doc_id"), F.col("unit")], "doc_id long, unit string").collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(texts) and all(0 <= r.score <= 1 for r in out)
    assert by[1].score == by[2].score == by[4].score and by[6].score == by[7].score
    hit = by[len(texts) - 1]
    assert hit.predicted == 1 and [texts[-1][s.start:s.end] for s in hit.spans] == ["SCUMBAG"]
    assert by[0].predicted == 0
    assert toxicity.fit(notes, labels.filter("toxic = 1")) is None
    assert toxicity.fit(notes.limit(0), labels) is None
    assert {r.score for r in toxicity.score(df, None, [F.col("doc_id")], "doc_id long").collect()} == {0.0}
    assert toxicity.score(df.limit(0), model, [F.col("doc_id")], "doc_id long").count() == 0
