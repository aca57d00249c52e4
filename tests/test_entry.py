"""The driver's entry without the optional subpackage, or without what that needs."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


def names(prelude: str) -> list[str]:
    code = f"import sys\n{prelude}\nimport __spark_entry__ as e\nprint(*e.queries())\nassert set(e.oracle_sql()) <= set(e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


@pytest.mark.parametrize("gone", ["tripline.llm", "tripline.llm.queries", "corpus_pipeline"])
def test_core_queries_need_nothing_optional(gone):
    found = names(f"sys.modules[{gone!r}] = None")
    assert "gold_avg_total_amount_by_month" in found and len(found) > 40
    assert not any(name.startswith("op") or name == "pipeline" for name in found)


def test_a_broken_core_is_not_hidden():
    code = "import sys\nsys.modules['tripline.plans.answers'] = None\nimport __spark_entry__"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode != 0 and "tripline.plans.answers" in done.stderr

