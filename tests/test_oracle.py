"""The correctness gate: every registered query against its DuckDB twin at sf0.01."""
import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF01
from tests.harness import compare

ORACLE = oracle_sql()
QUERIES = queries()


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_rows_only_queries_are_few():
    rows_only = sorted(k for k in set(QUERIES) - set(ORACLE) if k != "pipeline" and not re.match(r"op\d+_", k))
    assert rows_only == ["model_roundtrip", "train_linear_avg", "train_mlp", "train_sequence", "video_train_eval"]


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    r = compare(spark, duck, key, SF01, ORACLE.get(key), QUERIES[key])
    assert r["status"] in ("ok", "rows-only"), r
    assert r["rows"] > 0


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["id", "name", "n_steps", "true_len", "frames", "labels", "hot"]
