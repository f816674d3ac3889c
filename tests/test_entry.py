"""The entry points with and without the text operators."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]

HIDDEN = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {hidden!r} or name == {hidden!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as entry
names = set(entry.queries())
assert "surge_by_hour" in names and set(entry.oracle_sql()) <= names
assert not any(name.startswith("op") or name == "pipeline" for name in names), names
"""


@pytest.mark.parametrize("hidden", ["public_tokenizers", "tokenizers", "sentencepiece", "corpus_pipeline", "tidefare.llm"])
def test_other_queries_stand_without_the_text_operators(hidden):
    done = subprocess.run([sys.executable, "-c", HIDDEN.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
