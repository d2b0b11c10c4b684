"""What the entry registers when optional packages are missing."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from streamloader.plans.queries import QUERIES

HIDDEN = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as entry
print(*sorted(entry.queries()))
"""


@pytest.mark.parametrize("name", ["tokenizers", "xxhash", "corpus_pipeline", "streamloader.llm.queries"])
def test_core_queries_stand_alone(name):
    root = Path(__file__).resolve().parents[1]
    out = subprocess.run([sys.executable, "-c", HIDDEN.format(name=name)], cwd=root, capture_output=True, text=True, check=True)
    assert out.stdout.split() == sorted(QUERIES)
