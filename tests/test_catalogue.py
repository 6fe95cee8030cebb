"""Every catalogue query against its DuckDB oracle on the smallest tables."""

import os

import pytest

from claimloom.plans import catalogue, views

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(round(float(r[i]), 6)) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name in catalogue.oracle_sql():
        q = duck.sql(catalogue.oracle_sql()[name])
        assert canonical(rows, df.columns) == canonical(q.fetchall(), q.columns)
    else:
        assert df.columns


GROWN = "claim_rollup resolve_endpoints verdicts claim_status agreement_summary status_by_bucket dispute_ranking witness_rates omissions omission_ranking edge_dedup node_merge".split()


@pytest.mark.parametrize("name", GROWN)
def test_query_on_tables_taken_for_large(spark, duck, name, monkeypatch):
    monkeypatch.setattr(views, "SLICE", 16 << 10)
    monkeypatch.setattr(views, "SMALL", 0)
    assert views.slices(spark, SF) > 4
    test_query(spark, duck, name)


@pytest.mark.parametrize(("name", "most"), [("claim_rollup", 1), ("resolve_endpoints", 3), ("verdicts", 2), ("claim_status", 2), ("agreement_summary", 2), ("status_by_bucket", 2), ("dispute_ranking", 2), ("witness_rates", 3), ("witness_node_map", 2)])
def test_lines_are_read_few_times(spark, name, most, capsys):
    """Every reading of the lines is a join with the parts, a shuffle and a sort of its own unless Spark can reuse it."""
    catalogue.queries()[name](spark, SF).explain()
    assert 0 < capsys.readouterr().out.count("/lineitem.parquet]") <= most
