"""Every key with oracle SQL: Spark result equals the DuckDB result exactly."""

import datetime as dt
import math

import pandas as pd
import pytest

import __spark_entry__ as entry
from tripdemand import catalog
from tripdemand.oracle.fixture_sql import with_ctes
from tests.conftest import SF_SMALL

ORACLE = catalog.ORACLE


def _norm(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return (0, "")
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        if v.is_integer() and abs(v) < 2 ** 53:
            return (1, repr(int(v)))
        return (1, repr(v))
    if isinstance(v, dt.datetime):
        return (1, v.date().isoformat() if v.time() == dt.time(0) else v.isoformat())
    if isinstance(v, dt.date):
        return (1, v.isoformat())
    return (1, repr(v))


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None))


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, duck, key):
    got = catalog.QUERIES[key](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLE[key]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_every_own_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(ORACLE)


def test_report_means_are_plain_averages_within_a_cent(spark, duck):
    """The oracle's exact means against DuckDB's own AVG, which rounds floating sums."""
    sql = with_ctes("""
      SELECT hour, day_of_week, category, operator_name, ROUND(AVG(avg_fare), 2) AS fare, ROUND(AVG(avg_tip), 2) AS tip
      FROM agg_hourly_demand GROUP BY 1, 2, 3, 4""")
    plain = {r[:4]: r[4:] for r in duck.execute(sql).fetchall()}
    got = catalog.hourly_profile_df(spark, SF_SMALL).collect()
    assert len(got) == len(plain) > 20
    for r in got:
        for ours, theirs in zip((r.avg_fare, r.avg_tip), plain[(r.hour, r.day_of_week, r.category, r.operator_name)]):
            assert (ours is None) == (theirs is None) and (ours is None or abs(ours - theirs) < 0.0101)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "trip_count" in df.columns


@pytest.mark.parametrize("key", ["agg_hourly_demand", "weather_explode", "scenario_grid", "clean_yellow"])
def test_session_time_zone_does_not_change_results(spark, duck, key):
    from tripdemand import catalog
    old = spark.conf.get("spark.sql.session.timeZone")
    saved = dict(catalog._PLANS)
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        catalog._PLANS.clear()
        got = catalog.QUERIES[key](spark, SF_SMALL).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
        catalog._PLANS.clear()
        catalog._PLANS.update(saved)
    assert _rows(got) == _rows(duck.execute(ORACLE[key]).df())
