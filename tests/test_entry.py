"""The driver's entry points without parts of the library."""

import subprocess
import sys

import pytest

from talmir.plans.registry import QUERIES

SCRIPT = """
import sys
for name in {missing!r}:
    sys.modules[name] = None
import __spark_entry__ as entry
print(sorted(entry.queries()), sorted(entry.oracle_sql()))
"""


@pytest.mark.parametrize(
    "missing", [["ahocorasick"], ["xxhash", "pyarrow.fs"], ["talmir.llm"], ["talmir.llm", "corpus_pipeline"]]
)
def test_core_queries_are_there_without_a_library(missing):
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(missing=missing)], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert all(f"'{name}'" in done.stdout for name in QUERIES)
    assert "'op1_warc'" not in done.stdout and "'pipeline'" not in done.stdout
