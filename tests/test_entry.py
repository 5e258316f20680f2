"""The registered queries against their SQL, on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry_module

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
SLOW = ("dbscan", "topn_cluster", "label_overlap", "label_remap", "connected")


def test_every_query_but_the_random_one_has_sql():
    own = entry_module._queries.QUERIES
    assert set(own) - set(entry_module.oracle_sql()) == {"ml_kmeans"}
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 5 and sum(r["count"] for r in rows) > 0


@pytest.fixture(scope="module")
def sql(trips_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{trips_dir}/{name}.parquet'")
    return con


def plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def names():
    chosen = sorted(set(entry_module.oracle_sql()) & set(entry_module._queries.QUERIES))
    if os.environ.get("ALL_QUERIES"):
        return chosen
    return [n for n in chosen if not n.startswith(SLOW)] + ["dbscan_with_noise"]


@pytest.mark.parametrize("name", names())
def test_query_matches_sql(spark, sql, trips_dir, name):
    frame = entry_module.queries()[name](spark, trips_dir)
    columns = sorted(frame.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in frame.collect()]
    cursor = sql.execute(entry_module.oracle_sql()[name])
    order = [d[0] for d in cursor.description]
    assert sorted(order) == columns
    want = [tuple(plain(r[order.index(c)]) for c in columns) for r in cursor.fetchall()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
