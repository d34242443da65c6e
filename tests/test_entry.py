"""The entry without the training-data part or one of its libraries."""

import subprocess
import sys

import pytest

from tests.conftest import ROOT

CODE = """
import sys, warnings
class Gone:
    def find_spec(self, name, path=None, target=None):
        if any(name == g or name.startswith(g + ".") for g in {gone}):
            raise {error}(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Gone())
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as E
assert "op1_langid" not in E.queries() and "pipeline" not in E.queries()
assert "cl_clients" in E.oracle_sql() and len(E.queries()) == len(E.oracle_sql()) > 60
assert any("left out" in str(w.message) for w in said), said
"""


@pytest.mark.parametrize("gone,error", [(["corpus_pipeline", "marginflow.llm"], "ModuleNotFoundError"),
                                        (["zstandard"], "ModuleNotFoundError"), (["public_tokenizers"], "ImportError")])
def test_analytics_queries_survive(gone, error):
    subprocess.run([sys.executable, "-c", CODE.format(gone=gone, error=error)], check=True, cwd=ROOT, timeout=120)
