"""The entry file stands without the optional subpackage or what that needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys, warnings
for name in sys.argv[1:]:
    sys.modules[name] = None  # as if it could not be found
with warnings.catch_warnings(record=True) as told:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
print(len(entry.QUERIES), len(entry.queries()), len(set(entry.oracle_sql()) - set(entry.queries())), len(told))
"""


@pytest.mark.parametrize(
    "missing, warned", [((), 0), (("public_tokenizers",), 1), (("zstandard", "tiktoken"), 1), (("vitalgrid.llm",), 0), (("corpus_pipeline",), 0)]
)
def test_core_queries_stand_alone(missing, warned):
    there = os.path.isdir(os.path.join(ROOT, "vitalgrid", "llm"))
    out = subprocess.run([sys.executable, "-c", SCRIPT, *missing], cwd=ROOT, capture_output=True, text=True, check=True).stdout
    core, every, unknown, told = map(int, out.split())
    assert core >= 58 and unknown == 0
    assert every == core or (there and not missing and every > core)
    assert told == (warned if there else 0)
