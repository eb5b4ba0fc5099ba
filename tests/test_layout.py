"""The optional subpackage is optional, and sessions keep their settings."""

from __future__ import annotations

import re
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_nothing_else_imports_the_subpackage():
    users = [p for p in (ROOT / "corpusloom").rglob("*.py") if "llm" not in p.parts and re.search(r"(import|from)\s.*\bllm\b", p.read_text())]
    assert users == []


def test_entry_without_the_subpackage(tmp_path):
    code = "import sys; sys.modules['corpusloom.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'p1_found' in q and 'p8_ids' not in q and set(e.oracle_sql()) <= set(q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_checkpoint_and_tables(spark, tmp_path):
    from corpusloom.session import checkpointed, table

    spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS t").write.parquet(str(tmp_path / "x.parquet"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert table(spark, str(tmp_path), "x").count() == 1
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert checkpointed(spark.range(5)).count() == 5
    assert spark.sparkContext.getCheckpointDir() is not None
