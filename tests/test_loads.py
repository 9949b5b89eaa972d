"""Loads that fail leave the old tables; loads that are repeated change nothing."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripdemand import catalog
from tripdemand import fixtures as fx
from tripdemand.operators import ml, warehouse
from tripdemand.plans import model as model_job
from tripdemand.plans import warehouse as job
from tripdemand.session import scratch_path
from tripdemand.sources import commits
from tripdemand.sources import trips as src


def failing(df):
    """The same columns, of which the first fails while it is written."""
    first, *others = df.schema
    lost = F.when(F.monotonically_increasing_id() >= 0, F.raise_error(F.lit("lost")).cast(first.dataType)).otherwise(F.col(first.name))
    return df.select(lost.alias(first.name), *[f.name for f in others])


def test_a_failed_write_leaves_the_old_table(spark):
    root = scratch_path(spark, "commits")
    old = spark.range(5).withColumn("part", (F.col("id") % 2).cast("string"))
    change = commits.Change(spark, root)
    change.replace("t", old, ["part"])
    change.publish()
    for how in ("replace", "replace_parts", "append"):
        with pytest.raises(Exception, match="lost"):
            broken = commits.Change(spark, root)
            getattr(broken, how)("t", failing(old.select("id", "part")), ["part"])
            broken.publish()
        assert {tuple(r) for r in commits.read_committed(spark, root, "t").collect()} == {(i, str(i % 2)) for i in range(5)}
    # staged but never published: not seen either
    commits.Change(spark, root).replace("t", old.limit(0))
    assert commits.read_committed(spark, root, "t").count() == 5


def test_parts_are_replaced_emptied_and_added(spark):
    root = scratch_path(spark, "parts")
    rows = lambda *xs: spark.createDataFrame([(p, v) for p, v in xs], "p string, v int")
    first = commits.Change(spark, root)
    first.replace("t", rows(("a", 1), ("b", 2), ("c", 3)), ["p"])
    first.replace("none", rows(), ["p"])
    first.publish()
    second = commits.Change(spark, root)
    second.replace_parts("t", rows(("a", 9)), ["p"], gone=["p=b"])
    assert {tuple(r) for r in second.staged("t").collect()} == {("a", 9), ("c", 3)}
    assert {tuple(r) for r in commits.read_committed(spark, root, "t").collect()} == {("a", 1), ("b", 2), ("c", 3)}
    second.append("t", rows(("a", 10)), ["p"])
    second.publish()
    assert {tuple(r) for r in commits.read_committed(spark, root, "t").collect()} == {("a", 9), ("c", 3), ("a", 10)}
    assert commits.read_committed(spark, root, "none").columns == ["p", "v"] and commits.read_committed(spark, root, "none").count() == 0
    with pytest.raises(FileNotFoundError):
        commits.read_committed(spark, root, "other")


def test_two_writers_one_wins(spark):
    root = scratch_path(spark, "race")
    a, b = commits.Change(spark, root), commits.Change(spark, root)
    a.replace("t", spark.range(1))
    b.replace("t", spark.range(2))
    a.publish()
    with pytest.raises(RuntimeError, match="another writer"):
        b.publish()
    assert commits.read_committed(spark, root, "t").count() == 1


def test_unused_versions_are_removed(spark):
    root = scratch_path(spark, "vacuum")
    for n in (1, 2, 3):
        change = commits.Change(spark, root)
        change.replace("t", spark.range(n))
        change.publish()
    commits.Change(spark, root).replace("t", spark.range(9))  # staged and left
    assert len(commits.remove_unused(spark, root, keep=1)) == 3
    assert commits.read_committed(spark, root, "t").count() == 3 and commits.commit_numbers(spark, root) == [3]


def test_a_failed_clean_write_keeps_the_old_months(spark):
    path = scratch_path(spark, "clean")
    clean = catalog.clean_all_df(spark, SF_SMALL)
    src.write_clean(clean, path, fx.FIXTURE_MONTHS)
    with pytest.raises(Exception, match="lost"):
        src.write_clean(failing(clean.where(F.col("file_month") == fx.FIXTURE_MONTHS[0])), path, fx.FIXTURE_MONTHS)
    assert src.read_clean(spark, path).exceptAll(clean).count() == 0 and src.read_clean(spark, path).count() == clean.count()


def test_a_failed_batch_leaves_the_warehouse(spark, monkeypatch):
    land, weather = fx.landed(spark, SF_SMALL), catalog.weather_hourly_df(spark, SF_SMALL)
    out = scratch_path(spark, "batch")
    job.build_warehouse(spark, land.trips, out, fx.FIXTURE_MONTHS, weather)
    counts = {t: job.read_table(spark, out, t).count() for t in job.TABLES}
    real = job.aggregates.zone_of_state
    monkeypatch.setattr(job.aggregates, "zone_of_state", lambda *a: failing(real(*a)))
    with pytest.raises(Exception, match="lost"):  # the fact of one month is staged by then
        job.build_warehouse(spark, land.trips, out, fx.FIXTURE_MONTHS[:1], weather)
    assert {t: job.read_table(spark, out, t).count() for t in job.TABLES} == counts


def test_repeated_appends_change_nothing(spark):
    land, weather = fx.landed(spark, SF_SMALL), catalog.weather_hourly_df(spark, SF_SMALL)
    out, whole = scratch_path(spark, "append"), scratch_path(spark, "whole")
    job.build_warehouse(spark, land.trips, out, fx.FIXTURE_MONTHS[:1], weather)
    assert job.append_months(spark, land.trips, out, fx.FIXTURE_MONTHS) == list(fx.FIXTURE_MONTHS[1:])
    before = commits.commit_numbers(spark, out)
    assert job.append_months(spark, land.trips, out, fx.FIXTURE_MONTHS) == []
    assert commits.commit_numbers(spark, out) == before
    job.build_warehouse(spark, land.trips, whole, fx.FIXTURE_MONTHS, weather)
    for table in ("agg_hourly_demand", "agg_zone_demand", "dim_weather"):
        a, b = job.read_table(spark, out, table), job.read_table(spark, whole, table)
        assert a.exceptAll(b).count() == 0 and a.count() == b.count()
    fact = job.read_table(spark, out, "fact_trips")
    n = fact.count()
    assert fact.agg(F.min("trip_id"), F.max("trip_id"), F.countDistinct("trip_id")).first() == (1, n, n)
    assert job.read_table(spark, out, job.LEDGER).agg(F.sum("row_count")).first()[0] == n == job.read_table(spark, whole, "fact_trips").count()


def test_an_append_reads_only_the_new_month(spark, monkeypatch):
    land, weather = fx.landed(spark, SF_SMALL), catalog.weather_hourly_df(spark, SF_SMALL)
    out = scratch_path(spark, "one-month")
    job.build_warehouse(spark, land.trips, out, fx.FIXTURE_MONTHS[:-1], weather)
    asked = []
    real = src.read_trips
    monkeypatch.setattr(src, "read_trips", lambda s, root, service, months=None: asked.append(tuple(months)) or real(s, root, service, months))
    states = []
    real_state = job.aggregates.trip_state
    monkeypatch.setattr(job.aggregates, "trip_state", lambda fact, keep=(): states.append({r[0] for r in fact.select("file_month").distinct().collect()}) or real_state(fact, keep))
    job.append_months(spark, land.trips, out, fx.FIXTURE_MONTHS)
    assert asked == [(fx.FIXTURE_MONTHS[-1],)] * 2 and states == [{fx.FIXTURE_MONTHS[-1]}]


def test_an_append_after_a_failure_does_what_is_left(spark, monkeypatch):
    land, weather = fx.landed(spark, SF_SMALL), catalog.weather_hourly_df(spark, SF_SMALL)
    out = scratch_path(spark, "retry")
    job.build_warehouse(spark, land.trips, out, fx.FIXTURE_MONTHS[:1], weather)
    n = job.read_table(spark, out, "fact_trips").count()
    real = job.aggregates.hourly_of_state
    monkeypatch.setattr(job.aggregates, "hourly_of_state", lambda *a: failing(real(*a)))
    with pytest.raises(Exception, match="lost"):
        job.append_months(spark, land.trips, out, fx.FIXTURE_MONTHS[:2])
    assert job.read_table(spark, out, "fact_trips").count() == n
    monkeypatch.setattr(job.aggregates, "hourly_of_state", real)
    assert job.append_months(spark, land.trips, out, fx.FIXTURE_MONTHS[:2]) == [fx.FIXTURE_MONTHS[1]]
    blocks = {(r.service, r.file_month): (r.first_id, r.trips) for r in warehouse.id_blocks(job.read_table(spark, out, "fact_trips", folder=True)).collect()}
    ledger = {(r.service, r.file_month): (r.first_id, r.row_count) for r in job.read_table(spark, out, job.LEDGER).collect()}
    assert blocks == ledger and len(ledger) == 4


def test_artifacts_are_of_one_make(spark, monkeypatch):
    features = ml.build_features(catalog.agg_hourly_df(spark, SF_SMALL))
    root = scratch_path(spark, "one-make")
    model_job.build_model(spark, root, features, fx.FIXTURE_CUT, n_trees=2)
    old = {t: sorted(map(str, df.collect())) for t, df in model_job.load_artifacts(spark, root).items()}
    monkeypatch.setattr(ml, "feature_importance", lambda *a: failing(spark.range(3)).withColumn("label", F.lit(1)))
    with pytest.raises(Exception, match="lost"):  # model and predictions of the new make are written by then
        model_job.build_model(spark, root, features, fx.FIXTURE_CUT, n_trees=3)
    assert {t: sorted(map(str, df.collect())) for t, df in model_job.load_artifacts(spark, root).items()} == old
    fresh = scratch_path(spark, "no-make")
    with pytest.raises(Exception, match="lost"):
        model_job.build_model(spark, fresh, features, fx.FIXTURE_CUT, n_trees=2)
    assert model_job.load_artifacts(spark, fresh) is None


def row_groups(path, zones):
    """(all, those whose bounds admit a zone, summed over the zones) of the Parquet files below a folder."""
    import pathlib

    import pyarrow.parquet as pq

    bounds = []
    for f in pathlib.Path(path.removeprefix("file:")).rglob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.to_arrow_schema().get_field_index("PULocationID")
        bounds += [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
    return len(bounds), sum(b.min <= z <= b.max for b in bounds for z in zones)


def test_a_zone_reads_fewer_row_groups(spark):
    root = scratch_path(spark, "layout")
    clean = src.read_clean(spark, f"{catalog.warehouse_root(spark, SF_SMALL)}/clean")
    # twenty times the trips, dealt out so that copies are apart
    fact = warehouse.fact_of_files(clean, keep=("file_month",)).coalesce(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20)))).repartition(16, "n", "trip_id").drop("n")
    small = {"parquet.block.size": "2048", "parquet.block.size.row.check.min": "10", "parquet.page.size.row.check.min": "5", "parquet.block.row.count.limit": "20"}
    change = commits.Change(spark, root)
    fact = fact.coalesce(1)
    change.replace("as_numbered", fact, ["file_month"], **small)
    change.replace("by_zone", job.by_zone(fact), ["file_month"], **small, **job.FACT_OPTIONS)
    change.publish()
    zones = [r[0] for r in fact.select("PULocationID").distinct().collect()]
    groups, plain = row_groups(commits.table_path(spark, root, "as_numbered"), zones)
    sorted_groups, by_zone = row_groups(commits.table_path(spark, root, "by_zone"), zones)
    assert groups >= 20 and sorted_groups >= 20
    assert by_zone * 3 <= plain  # row groups read for each zone, over all zones
    zone = zones[0]
    scan = commits.read_committed(spark, root, "by_zone").where(F.col("PULocationID") == zone)
    assert "EqualTo(PULocationID" in scan._jdf.queryExecution().executedPlan().toString()
    assert scan.count() == fact.where(F.col("PULocationID") == zone).count()
