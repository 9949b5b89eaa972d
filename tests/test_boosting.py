"""Boosted trees: the same trees for every layout, scores and importances that follow from the table of nodes."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tripdemand import catalog
from tripdemand.operators import boosting, ml

SETTINGS = dict(n_trees=12, max_depth=4, learning_rate=0.1, subsample=0.8, colsample=0.7, max_bins=32, seed=5)
FEATURES = ("a", "b", "c", "d")


def rows(spark, n=3000):
    rng = random.Random(3)
    data = []
    for i in range(n):
        a, b, c = rng.randrange(24), rng.gauss(0, 5), rng.choice([0, 1, None])
        data.append((i, a, b if i % 50 else None, c, 1.0, None if i % 97 == 0 else float(round(3 * a + 10 * (b > 1) + (c or 0) * 5 + rng.gauss(0, 1)))))
    return spark.createDataFrame(data, "id int, a int, b double, c int, d double, y double")


def fitted(df, **more):
    return sorted(map(tuple, boosting.fit_trees(df, ["id"], FEATURES, "y", **{**SETTINGS, **more}).collect()), key=lambda r: r[:2])


def plain_score(nodes, row):
    total = 0.0
    for tree in {t for t, _ in nodes}:
        n = 1
        while nodes[tree, n][2] is not None:
            _, _, feature, cut, *_ = nodes[tree, n]
            v = row[feature]
            n = 2 * n + (v is not None and not np.isnan(v) and v > cut)
        total += nodes[tree, n][4]
    return total


def test_layout_does_not_matter(spark):
    df = rows(spark)
    want = fitted(df.coalesce(1))
    assert len({r[0] for r in want}) == 13
    for parts, tasks in ((3, None), (8, None), (5, 2), (8, 4), (1, 3)):
        again = df.repartition(parts, F.rand(parts)) if parts > 1 else df.coalesce(1)
        assert fitted(again, tasks=tasks) == want


def test_demand_model_is_the_same_over_one_three_and_eight_partitions(spark):
    train, test = catalog.split_df(spark, SF_MID)
    models = [ml.fit_demand(train.repartition(n), n_trees=20) for n in (1, 3, 8)]
    trees = [sorted(map(str, m.collect())) for m in models]
    assert trees[0] == trees[1] == trees[2]
    scores = [sorted(map(str, ml.predict_demand(m, test.repartition(n)).collect())) for m, n in zip(models, (8, 1, 3))]
    assert scores[0] == scores[1] == scores[2]


def test_scores_follow_the_nodes(spark):
    df = rows(spark, 1200)
    table = boosting.fit_trees(df, ["id"], FEATURES, "y", **SETTINGS).checkpoint()
    nodes = {(r.tree, r.node): tuple(r) for r in table.collect()}
    strange = spark.createDataFrame([(1, None, float("nan"), None, None, None), (1, None, float("nan"), None, None, None), (2, 99, -1e9, 7, 0.0, 1.0)], df.schema)
    asked = df.unionAll(strange).withColumn("node", F.lit("x")).withColumn("value", F.lit(0)).repartition(5)
    got = boosting.score_trees(asked, table)
    assert got.columns == [*asked.columns, "prediction"]
    got = got.collect()
    assert len(got) == 1203
    for r in got:
        assert r.prediction == plain_score(nodes, r.asDict())


def test_rows_are_scored_by_all_cores(spark):
    df = rows(spark, 400)
    table = boosting.fit_trees(df, ["id"], FEATURES, "y", **SETTINGS).checkpoint()
    plan = boosting.score_trees(df.coalesce(1), table)._jdf.queryExecution().executedPlan().toString()
    assert f"RoundRobinPartitioning({spark.sparkContext.defaultParallelism})" in plan


def test_exported_trees_score_the_same_in_sql(spark, tmp_path):
    import duckdb

    train, test = catalog.split_df(spark, SF_MID)
    model = ml.fit_demand(train, n_trees=40)
    model.write.parquet(str(tmp_path / "nodes"))
    test.write.parquet(str(tmp_path / "rows"))
    con = duckdb.connect()
    con.execute(f"CREATE TABLE nodes AS FROM '{tmp_path}/nodes/*.parquet'")
    con.execute(f"CREATE TABLE asked AS SELECT row_number() OVER () AS r, * FROM '{tmp_path}/rows/*.parquet'")
    pairs = ", ".join(f"('{f}', CAST({f} AS DOUBLE))" for f in ml.FEATURE_COLS)
    con.execute(f"CREATE TABLE cells AS SELECT r, p.f, p.v FROM asked, LATERAL (VALUES {pairs}) p(f, v)")
    scored = con.execute("""
        WITH RECURSIVE down AS (
            SELECT r, tree, 1 AS node FROM asked, (SELECT DISTINCT tree FROM nodes)
            UNION ALL
            SELECT down.r, down.tree, 2 * down.node + CASE WHEN v > threshold THEN 1 ELSE 0 END
            FROM down JOIN nodes USING (tree, node) JOIN cells ON cells.r = down.r AND f = feature)
        SELECT a.date, a.hour, a.PULocationID, a.operator_name, round_even(greatest(0, sum(value)) * 10, 0) / 10 AS predicted
        FROM down JOIN nodes USING (tree, node) JOIN asked a USING (r) WHERE feature IS NULL GROUP BY ALL""").fetchall()
    ours = ml.predict_demand(model, test).select("date", "hour", "PULocationID", "operator_name", "predicted").collect()
    assert sorted(map(tuple, ours)) == sorted(scored)


def test_importances_follow_the_nodes(spark):
    train, _ = catalog.split_df(spark, SF_MID)
    model = ml.fit_demand(train, n_trees=15)
    gains = {}
    for r in model.where("feature is not null").collect():
        gains.setdefault(r.feature, []).append(r.gain)
    mean = {f: sum(g) / len(g) for f, g in gains.items()}
    for r in ml.feature_importance(model).collect():
        assert r.importance == pytest.approx(mean.get(r.feature, 0.0) / sum(mean.values()))


def test_each_tree_sees_its_columns_and_its_share_of_rows(spark):
    nodes = fitted(rows(spark), n_trees=30)
    used = {t: {r[2] for r in nodes if r[0] == t and r[2]} for t in range(1, 31)}
    allowed = {t: {FEATURES[i] for i in boosting.columns_of(t, 4, 0.7, 5)} for t in used}
    assert all(len(a) == 3 and used[t] <= a for t, a in allowed.items())
    assert len({tuple(sorted(a)) for a in allowed.values()}) > 1
    labelled = nodes[0][6]
    roots = [r[6] / labelled for r in nodes if r[0] > 0 and r[1] == 1]
    assert 0.75 < min(roots) and max(roots) < 0.85 and len(set(roots)) > 5


def test_a_whole_sample_in_one_tree_splits_where_the_error_falls_most(spark):
    df = spark.createDataFrame([(i, float(i), 0.0 if i < 7 else 10.0) for i in range(20)], "id int, x double, y double")
    nodes = {r.node: r for r in boosting.fit_trees(df, ["id"], ["x"], "y", 1, 1, 1.0, 1.0, 1.0, 256, 1, ridge=0.0).where("tree = 1").collect()}
    assert nodes[1].threshold == 6.5 and nodes[1].row_count == 20
    assert nodes[2].value == pytest.approx(-6.5) and nodes[3].value == pytest.approx(3.5)


def test_empty_and_constant_labels(spark):
    df = rows(spark, 100)
    empty = fitted(df.limit(0))
    assert empty == [(0, 1, None, None, 0.0, None, 0)]
    same = fitted(df.withColumn("y", F.lit(7.0)))
    assert same[0][4] == 7.0 and all(r[2] is None and r[4] == 0.0 for r in same[1:])


def test_thresholds_at_equal_shares(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"), F.lit(3.0).alias("same"), F.lit(None).cast("double").alias("none"))
    cuts = boosting.thresholds(df, ["x", "same", "none"], 11)
    assert len(cuts[0]) == 10 or len(cuts[0]) == 9
    assert all(abs((b - a) - 100) <= 1 for a, b in zip(cuts[0], cuts[0][1:])) and cuts[1:] == [[], []]


def test_scenarios_keep_their_rows(spark):
    train, _ = catalog.split_df(spark, SF_MID)
    model = ml.fit_demand(train, n_trees=3)
    scen = spark.createDataFrame([(dt.date(2024, 3, 4), 161, "Modern", "Uber", 1.5, 0.2, 10.0)] * 2,
                                 "date date, PULocationID int, category string, operator_name string, temperature double, precipitation double, windspeed double")
    assert ml.score_scenarios(model, ml.scenario_grid(scen)).count() == 48
