"""The entry module serves the core queries whether or not the optional parts can be imported."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from workload import QUERIES

ROOT = Path(__file__).resolve().parents[1]

#: Modules that cannot be imported in a run: the subpackage itself, what it needs, or the pipeline beside it.
ABSENT = [["lakeops.llm"], ["lakeops.llm.queries"], ["public_tokenizers"], ["corpus_pipeline"]]


@pytest.mark.parametrize("absent", ABSENT, ids=lambda names: names[0])
def test_core_queries_without_optional_parts(absent):
    code = (
        f"import sys\nfor name in {absent!r}: sys.modules[name] = None\n"
        "import __spark_entry__ as e\nprint(len(e.queries()), 'pipeline' in e.queries(), 'dedup_latest' in e.oracle_sql())"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    count, pipeline, core = done.stdout.split()
    assert int(count) >= len(QUERIES) and core == "True"
    assert pipeline == str(absent == ["lakeops.llm.queries"])
