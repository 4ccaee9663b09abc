"""The order queries stand without the corpus subpackage or the libraries that it needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCKED = """
import sys, warnings
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Blocked())
with warnings.catch_warnings(record=True) as caught:
    warnings.simplefilter("always")
    import __spark_entry__ as E
own = [q for q in E.queries() if not (q.startswith("op") and q[2:3].isdigit()) and q != "pipeline"]
print(len(own), set(E.oracle_sql()) <= set(E.queries()), sum("left out" in str(w.message) for w in caught), len(E.queries()) - len(own))
"""


def without(name):
    out = subprocess.run([sys.executable, "-c", BLOCKED.format(name=name)], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    return int(out[0]), out[1], int(out[2]), int(out[3])


@pytest.mark.parametrize("name", ["tiktoken", "tokenizers", "sentencepiece", "ahocorasick", "regex", "xxhash", "public_tokenizers", "orderlens.llm"])
def test_order_queries_without_a_library(name):
    import __spark_entry__ as E
    own = [q for q in E.queries() if not (q.startswith("op") and q[2:3].isdigit()) and q != "pipeline"]
    count, oracles, warned, others = without(name)
    assert (count, oracles) == (len(own), "True")
    present = os.path.isdir(os.path.join(ROOT, "orderlens", "llm"))
    # the subpackage itself may be absent without a word; a library that it lacks is named in a warning
    assert (warned, others) == (0, 0) or (name != "orderlens.llm" and present and warned == 1 and others == 0)
