"""Each query of the catalogue against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from lectern.plans import catalog, catalog_gates, catalog_more, catalog_records, catalog_release, catalog_texts  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda x: None if isinstance(x, float) and math.isnan(x) else round(x, 6) if isinstance(x, float) else x
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_equals_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    cursor = duck.execute(catalog.SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    assert plain([tuple(r) for r in got.collect()], got.columns) == plain(cursor.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_cases_are_met(spark):
    """Queries over planted cases must show them, or they would prove nothing."""
    values = lambda name, column: {r[0] for r in catalog.QUERIES[name](spark, SF).select(column).distinct().collect()}
    assert values("hit_matrix", "rule") == {"R01", "R01b", "R02", "R03a", "R03b", "R03c", "R03d", "R03e", "R03f", "R03g"}
    assert {"addition", "omission", "conflict", "alignment", "variant_reading", None} <= values("collation", "relation")
    assert values("anchor_check", "problem") == {None, "quote_differs", "forward_differs", "out_of_range", "no_anchor"}
    assert {"json", "shape", "empty", "type", "range", "coverage", "gap", "overlap", None} == values("proposal_parse", "error")
    assert values("offset_gate", "check") >= {"contiguous", "strict_offset", "quote_hash"}
    assert values("merge_refusals", "refusal") == {None, "missing", "other_kind", "referenced"} and values("split_refusals", "refusal") == {None, "missing", "allocation_differs", "referenced"}


def test_entry_has_unique_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
