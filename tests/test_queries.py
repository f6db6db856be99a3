import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from shelfwise.plans import oracles, registry
from tools.check_queries import compare, connect

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    if name in SQL:
        assert compare(df, con, SQL[name]) == ""
    else:
        assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "product_id" and df.count() > 0


def test_batch_functions_need_no_installed_package(tmp_path):
    """Python workers start elsewhere and cannot import this repository."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as entry
from shelfwise.session import get_session
spark = get_session(master="local[2]", **{{"spark.sql.shuffle.partitions": "2"}})
for name in ("topk_similar", "image_stats", "embed_images", "reconstruction_error"):
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
print("fine")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                          text=True, timeout=600)
    assert "fine" in done.stdout, done.stderr[-2000:]
