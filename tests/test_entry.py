"""The entry point with and without the training-data package."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

_BLOCKED = """
import sys

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name in {blocked!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
from sensorlake.plans import oracles, queries
assert entry.queries().keys() == queries.queries().keys()
assert entry.oracle_sql() == oracles.oracle_sql()
"""


def _run(code: str) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)


def test_the_library_stands_without_the_package():
    for blocked in (["corpus_pipeline"], ["sensorlake.llm"], ["corpus_pipeline", "sensorlake.llm"]):
        done = _run(_BLOCKED.format(blocked=blocked))
        assert done.returncode == 0, done.stderr


def test_a_missing_library_is_not_hidden():
    done = _run(_BLOCKED.format(blocked=["pyspark.sql.functions"]))
    assert "ModuleNotFoundError" in done.stderr


def test_nothing_else_imports_the_package():
    files = [p for p in (ROOT / "sensorlake").rglob("*.py") if "llm" not in p.relative_to(ROOT).parts]
    assert files and not any("sensorlake.llm" in p.read_text() or "corpus_pipeline" in p.read_text() for p in files)
