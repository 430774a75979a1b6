"""The registry, and a sample of its queries against their DuckDB twins at the smallest scale.

``python tests/check_oracle.py [dir]`` compares all of them.
"""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from plantlake.oracle import ORACLE_SQL
from plantlake.queries import QUERIES
from tests.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = (
    "prs1_timestamp_p9", "dup4_production_orders", "mrg4_maintenance_orders", "scd2_history",
    "scd4_version_at", "fct4_sensor_hourly", "vw1_oee_daily", "vw3_critical_equipment_fanout",
    "q13_sensor_range", "snk2_stored_upsert",
)


def test_registry():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("missing", ["public_tokenizers", "regex", "xxhash", "ahocorasick", "plantlake.llm", "corpus_pipeline"])
def test_entry_without_optional_packages(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = Path(__file__).resolve().parent.parent
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    queries, twins = map(int, out.split())
    assert queries >= len(QUERIES) and twins >= len(ORACLE_SQL)


def test_entry(spark):
    assert "quality_rate" in entry.entry(spark).columns


@pytest.mark.parametrize("name", SAMPLE)
def test_equals_twin(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name) is None
