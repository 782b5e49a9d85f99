"""The entry without the operators on text, or without a library they need."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as driver

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["ahocorasick", "tokenizers.missing", "tradelens.llm", "corpus_pipeline"])
def test_entry_without(missing):
    code = f"""
import sys, warnings
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r} or name.startswith({missing!r} + "."):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
warnings.simplefilter("ignore")
import __spark_entry__ as d
print(len(d.queries()), len(d.oracle_sql()), d.llm is None)
"""
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    queries, sql, without = said.stdout.split()
    if missing == "tokenizers.missing":  # nothing needs this one
        assert without == "False" or driver.llm is None
    else:
        assert (int(queries), without) == (len(driver.ANALYSES), "True") and int(sql) == int(queries)
