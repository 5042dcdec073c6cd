"""The entry without the corpus subpackage."""

import subprocess
import sys

from .conftest import ROOT

HIDDEN = """
import importlib.abc, sys

class Hide(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in {hidden} or name.startswith("workgrid.llm."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Hide())
sys.path.insert(0, {root!r})
import __spark_entry__ as e
queries, oracles = e.queries(), e.oracle_sql()
assert set(oracles) <= set(queries) and "staff_performance" in queries
assert not any(k.startswith("op") or k == "pipeline" for k in queries)
"""


def test_queries_without_the_corpus_subpackage():
    """Both with the pipeline file left behind and without it."""
    for hidden in (("workgrid.llm",), ("workgrid.llm", "corpus_pipeline")):
        code = HIDDEN.format(hidden=repr(hidden), root=ROOT)
        done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
        assert done.returncode == 0, done.stderr[-2000:]
