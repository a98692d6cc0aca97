"""The registered queries without the text operators or a library that these need."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[2]
HIDE = """
import sys, warnings
for name in {hidden!r}:
    sys.modules[name] = None
with warnings.catch_warnings(record=True) as told:
    warnings.simplefilter("always")
    import __spark_entry__ as e
assert set(e.QUERIES) <= set(e.queries()), "a query of the core is gone"
assert not any(n.startswith("op") for n in e.queries())
print([str(w.message) for w in told if "text operators" in str(w.message)])
"""


def without(*hidden: str) -> str:
    done = subprocess.run([sys.executable, "-c", HIDE.format(hidden=hidden)], cwd=ROOT,
                          capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return done.stdout


@pytest.mark.parametrize("library", ["tiktoken", "tokenizers", "xxhash", "zstandard",
                                     "public_tokenizers", "numpy"])
def test_a_missing_library_costs_the_text_operators_alone(library):
    assert library in without(library)


@pytest.mark.parametrize("absent", ["corpus_pipeline", "lakevault.llm"])
def test_without_the_text_subpackage(absent):
    without(absent)
