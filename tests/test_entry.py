"""The driver's contract, with and without the training-data operators."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parents[1]


def test_contract(spark):
    assert __spark_entry__.entry(spark).count() > 0
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries)


def test_without_llm(tmp_path):
    """A copy without those folders still imports and registers the rest."""
    import shutil

    shutil.copytree(ROOT / "threadmill", tmp_path / "threadmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'tag_facets' in q and not any(n.startswith('op1_') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
