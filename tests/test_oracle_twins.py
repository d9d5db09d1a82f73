"""A slice of the driver's correctness gate inside pytest: Spark query vs DuckDB twin on sf0.001."""
from __future__ import annotations

import importlib.util
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E

_spec = importlib.util.spec_from_file_location("oracle_check", Path(__file__).resolve().parents[1] / "scripts" / "oracle_check.py")
OC = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(OC)

NAMES = ["sql_sum", "groupby_count", "profile_numeric", "schema", "preview", "sql_join_using", "sql_not_in",
         "sql_window_rank", "sql_window_frames", "sql_asof", "sql_theta_join", "state_transitions", "flow_edges",
         "page_metadata", "front_matter", "summary_line", "context_snippet", "feedback_roundtrip"]


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in OC.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_twin(spark, con, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    stypes = {f.name: OC.spark_kind(f.dataType.simpleString()) for f in df.schema.fields}
    assert stypes == {d[0]: OC.duck_kind(str(d[1])) for d in res.description}
    assert len(srows) == len(drows)
    assert OC.digest(df.columns, srows)[0] == OC.digest(dcols, drows)[0]
