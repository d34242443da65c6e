"""The pipeline against brute force, and its guard."""

import subprocess
import sys
from collections import defaultdict

import pytest

import __spark_entry__ as E
import corpus_pipeline
from marginflow.llm import trie
from tests.conftest import ROOT, SF_SMALL
from tests.llm.test_corpus_operators import brute_components, check_packing


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name)
        stage(spark, docs, SF_SMALL).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def rows_of(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()]


def test_stages_return_documents(stages):
    columns = stages["documents"].columns
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == columns


def test_language_keeps_clean_documents(stages):
    before, after = rows_of(stages["documents"]), rows_of(stages["language"])
    assert set(after) <= set(before)
    gone = set(before) - set(after)
    assert len(gone) <= 0.03 * len(before)
    assert all(len(t or "") < 40 for _, t, *_ in gone)


def test_exact_stage_keeps_the_smallest_id(stages):
    groups = defaultdict(list)
    for r in rows_of(stages["language"]):
        groups[trie.normalise(r[1])].append(r)
    assert sorted(rows_of(stages["exact_dedup"])) == sorted(min(g) for g in groups.values())


def test_exact_stage_drops_a_row_by_its_own_text(spark):
    rows = [(1, "a Ä"), (5, "A Ä"), (5, "b"), (5, None), (7, ""), (None, "b"), (9, "B")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = [r[:2] for r in rows_of(corpus_pipeline.drop_exact_copies(spark, docs, SF_SMALL))]
    assert sorted(map(str, out)) == sorted(map(str, [(1, "a Ä"), (5, "b"), (5, None), (None, "b")]))


def test_near_stage_keeps_one_of_each_group(stages):
    rows = rows_of(stages["exact_dedup"])
    component, _ = brute_components({r[0]: r[1] for r in rows}, 80)
    assert sorted(rows_of(stages["near_dedup"])) == sorted(r for r in rows if component[r[0]] == r[0])


def test_mixing_repeats_rows(stages):
    before, after = rows_of(stages["near_dedup"]), rows_of(stages["mixing"])
    assert set(after) <= set(before)
    count = defaultdict(int)
    for r in after:
        count[r] += 1
    assert max(count.values()) <= 3
    size = lambda rows: sum(len((r[1] or "").split()) for r in rows)
    assert abs(size(after) - size(before)) < 0.1 * size(before)


def test_packing_holds_every_row(stages):
    rows = stages["packing"].collect()
    check_packing(rows, 4096)
    copies = defaultdict(int)
    for r in rows:
        copies[r.doc_id] += r.piece == 0
    want = defaultdict(int)
    for r in rows_of(stages["mixing"]):
        want[r[0]] += 1
    assert copies == want


def test_run_equals_the_stages(spark, stages):
    keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
    a = sorted(map(tuple, corpus_pipeline.run(spark, SF_SMALL).select(*keep).collect()))
    assert a == sorted(map(tuple, stages["packing"].select(*keep).collect()))


def test_stages_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, None, "en", None, None),
            *[(10 + i, f"the little house number {i} is on the hill and the cat sleeps in it", "en", "a", 50) for i in range(20)],
            *[(40 + i, f"das kleine haus nummer {i} steht auf dem berg und die katze schläft", "de", None, 50) for i in range(20)],
            (10, "the little house number 0 is on the hill and the cat sleeps in it", "en", "a", 50)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns or i == len(corpus_pipeline.STAGES) - 1
            n = out.count()
            assert n <= 3 * max(1, len(data))


def test_entry_registers_every_operator():
    names = set(E.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None
    assert set(E.oracle_sql()) <= names


def test_library_works_without_the_subpackage():
    """Imported as if the llm folder and the pipeline module were deleted."""
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("marginflow.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as E
assert E.llm is None and "op1_langid" not in E.queries() and "cl_clients" in E.oracle_sql()
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT, timeout=120)
