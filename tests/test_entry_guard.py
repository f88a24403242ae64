"""The entry module without the training-data operators or a library of theirs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = """
import importlib.abc, sys
class Missing(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Missing())
sys.path.insert(0, {root!r})
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), sum(k.startswith("op") and k[2].isdigit() or k == "pipeline" for k in e.queries()))
"""


def run(name):
    return subprocess.run([sys.executable, "-c", COUNT.format(name=name, root=ROOT)], capture_output=True, text=True, timeout=300, cwd="/")


@pytest.mark.parametrize("name", ["sentencepiece", "tokenizers", "regex", "xxhash", "public_tokenizers", "postlens.llm", "corpus_pipeline"])
def test_other_queries_stay(name):
    from postlens.plans import catalog
    got = run(name)
    assert got.returncode == 0, got.stderr
    queries, oracles, llm = map(int, got.stdout.split())
    assert queries == len(catalog.queries()) and oracles == len(catalog.oracle_sql()) and llm == 0


def test_a_missing_module_of_the_rest_is_an_error():
    got = run("postlens.operators.views")
    assert got.returncode != 0 and "views" in got.stderr
