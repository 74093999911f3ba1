"""Every registered query against its DuckDB oracle (sf0.001), as the driver does at sf0.01."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels " \
         "conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return None if v is None else str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple("" if x is None else x for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def own(names):
    """The queries of the reference's operators (the training-data operators have tests of their own)."""
    return [n for n in names if not re.match(r"op\d+_|pipeline$", n)]


@pytest.mark.parametrize("name", own(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    drows, dcols = cur.fetchall(), [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, rows) == _canon(dcols, drows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_cost_inr" in df.columns


def test_every_query_has_an_oracle():
    assert set(own(E.queries())) == set(own(E.oracle_sql()))


def test_registered_queries_cover_the_survey_plan():
    """queries() holds exactly the planned keys: 22 silver, 8 dims, 5 facts, 10 KPIs, ROAS, 20 reports, 16 more."""
    from adlake.operators.gold import DIMS, FACTS
    from adlake.operators.kpi import KPI_NAMES
    from adlake.operators.spec import SILVER_TABLES
    from adlake.plans.pipeline import REPORTS

    expected = ({f"silver_{s}" for s in SILVER_TABLES} | set(DIMS) | set(FACTS) | set(KPI_NAMES)
                | {"metric_roas", "audit_silver", "bronze_csv_roundtrip", "saved_tables", "saved_kpi_1_summary", "saved_columns",
                   "saved_bronze", "saved_kpi_tables", "saved_month_kpis", "saved_outcomes", "audit_saved_silver", "report_pack_saved",
                   "replaced_table", "bronze_contract", "bronze_csv_quarantine", "bronze_csv_multiline_ads_data", "bronze_csv_multiline_asset"}
                | {f"report_{r}" for r in REPORTS})
    assert set(own(E.queries())) == expected
    assert len(expected) == 22 + 8 + 5 + 10 + 1 + 20 + 16
