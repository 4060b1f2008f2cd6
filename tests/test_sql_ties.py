"""Queries against their SQL on tables that hold ties, equal rows and keys that small tables don't have."""

from __future__ import annotations

import os
from functools import reduce
from operator import add

import duckdb
import pytest

from lectern.operators import records
from lectern.plans import catalog, catalog_gates, catalog_records  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """Line items of which many are alike, and conversations whose ids have two of the remainders that faults are planted by."""
    at = str(tmp_path_factory.mktemp("ties"))
    con = duckdb.connect()
    con.execute(f"CREATE TABLE lineitem AS SELECT * REPLACE (l_orderkey % 40 AS l_orderkey, l_suppkey % 3 AS l_suppkey, CAST(CASE WHEN l_linenumber <> 3 THEN l_quantity // 13 * 13 END AS DOUBLE) AS l_quantity, l_linenumber % 2 AS l_linenumber, TIMESTAMP '1995-01-01' + to_days(CAST(l_partkey % 40 * 20 AS INTEGER)) AS l_shipdate) FROM '{SF}/lineitem.parquet', range(20)")
    con.execute(f"CREATE TABLE orders AS SELECT * FROM '{SF}/orders.parquet'")
    ids = [x for x in range(100_000) if x % 11 == 3 and x % 13 == 5 or x % 37 == 10 and x % 53 == 14 or x % 31 == 9 and x % 37 == 10][:300] + [11]
    con.execute(f"CREATE TABLE conversations AS SELECT CAST(i AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, 'user' AS role, 'text ' || turn AS text FROM (SELECT unnest({ids}) AS i), range(2) t(turn)")
    for t in ("lineitem", "orders", "conversations"):
        con.execute(f"COPY {t} TO '{os.path.join(at, t)}.parquet' (FORMAT parquet)")
    return at, con


@pytest.mark.parametrize("name", ["covered_intervals", "merged_intervals", "gap_groups", "reading_order", "structural_gate", "suite_evidence", "layout_verdict"])
def test_equals_sql_where_rows_are_alike(spark, tables, name):
    at, con = tables
    got = catalog.QUERIES[name](spark, at)
    cursor = con.execute(catalog.SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_a_mean_does_not_hang_on_the_order_of_lines(spark):
    """sums of these in two orders are on either side of 0.8 times their number."""
    orders = [[0.8, 0.8, 0.8, 0.7, 0.9], [0.8, 0.7, 0.8, 0.8, 0.9]]
    assert len({reduce(add, o) / len(o) < 0.80 for o in orders}) == 2
    for conf in orders:
        lines = spark.createDataFrame([(1, c, "x", 9, 5) for c in conf], "page long, conf double, text string, w int, h int").coalesce(1)
        assert [r.signals for r in records.layout_verdict(lines).collect()] == [["many_single_char_boxes", "mixed_orientation"]]
