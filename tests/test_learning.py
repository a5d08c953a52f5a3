"""Encoding checks, metrics and neighbours against brute force, training and reloading."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pyspark.ml.functions import vector_to_array

from tidemark.functions.encode import binary, one_hot_found
from tidemark.plans import dataset as D
from tidemark.plans import evaluate as V
from tidemark.plans import metrics as M
from tidemark.plans import models as L
from tidemark.plans import oversample as O
from tidemark.queries.learning import feature_table
from tidemark.sources.fixture import Fixture
from tidemark.sources.tables import write_metrics


@pytest.fixture(scope="module")
def features(spark):
    return feature_table(Fixture(spark, "/root/testdata/sf0.001"))


def test_binary_maps_are_checked(spark):
    for bad in ({"a": 0}, {"a": 0, "b": 1, "c": 1}, {"a": 1, "b": 2}):
        with pytest.raises(ValueError):
            binary(F.lit("a"), bad)


def test_many_values_become_one_vector(spark):
    """Both forms say the same: entry i of the vector is the column of the i-th value."""
    df = spark.range(21).select("id", F.when(F.col("id") < 20, F.format_string("v%02d", "id")).alias("c"))
    wide = {r["id"]: r for r in one_hot_found(df, "c").collect()}
    narrow = one_hot_found(df, "c", most_columns=10)
    assert narrow.columns == ["id", "c_vector"]
    for r in narrow.select("id", vector_to_array("c_vector").alias("v")).collect():
        assert [int(x) for x in r["v"]] == [wide[r["id"]][f"c_v{i:02d}"] for i in range(20)]
        assert sum(r["v"]) == (r["id"] < 20)


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "label int, score double")


def test_ranking_against_pairs(spark):
    rng = random.Random(3)
    pairs = [(int(rng.random() < 0.3), rng.randrange(20) / 20) for _ in range(300)]
    pos = [s for y, s in pairs if y]
    neg = [s for y, s in pairs if not y]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    curve = M.precision_recall_curve(scored(spark, pairs))
    got = M.ranking_scores(curve).first()
    assert math.isclose(got["roc_auc"], wins / len(pos) / len(neg), rel_tol=1e-12)
    points = {r["threshold"]: r for r in curve.collect()}
    for t, r in points.items():
        tp, fp = sum(s >= t for s in pos), sum(s >= t for s in neg)
        assert (r["tp"], r["fp"]) == (tp, fp)


def test_metrics_without_positives(spark):
    rows = V.evaluate(scored(spark, [(0, 0.1), (0, 0.9)]), "label", "score").collect()
    default = [r for r in rows if r["kind"] == "default"][0]
    assert (default["precision"], default["recall"], default["f1"]) == (0, 0, 0)
    assert default["fpr"] == 0.5 and default["roc_auc"] is None


def test_equal_f1_takes_the_lower_threshold(spark):
    # F1 is 2/3 at both 0.9 and 0.4
    curve = M.precision_recall_curve(
        scored(spark, [(1, 0.9), (0, 0.6), (0, 0.5), (1, 0.4)])
    )
    assert M.best_threshold(curve).first()["threshold"] == 0.4


def test_class_ratio_without_fraud(spark):
    df = spark.createDataFrame([(0,), (0,)], "is_fraudulent int")
    assert D.class_counts(df).first()["ratio"] == 1.0


def test_exact_split_sizes(spark):
    df = spark.range(5000).select(
        F.col("id").alias("transaction_id"), (F.col("id") % 50 == 0).cast("int").alias("is_fraudulent")
    )
    flagged = D.stratified_split_flag(df).groupBy("is_fraudulent", "is_test").count().collect()
    got = {(r["is_fraudulent"], r["is_test"]): r["count"] for r in flagged}
    assert got == {(0, False): 3920, (0, True): 980, (1, False): 80, (1, True): 20}


def test_scaling_of_a_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaling = D.fit_scaling(df, ["a", "b"])
    assert [tuple(r) for r in scaling.apply(df).orderBy("a").collect()] == [(-1, 0), (1, 0)]


@pytest.mark.parametrize("pivots,block", [(1, 10_000), (7, 20)])
def test_neighbours_against_all_pairs(spark, pivots, block):
    rng = random.Random(5)
    centres = [(0, 0, 0), (100, 0, 0), (0, 80, 5)]
    # half of the points share one spot's surroundings; whole numbers make ties
    points = {}
    for i in range(260):
        c = centres[0] if i < 130 else rng.choice(centres)
        points[tuple(float(x + rng.randrange(-9, 10)) for x in c)] = i
    rows = [(i, list(v)) for v, i in points.items()]
    df = spark.createDataFrame(rows, "point bigint, vector array<double>")
    got = {}
    for r in O.nearest_neighbours(df, 5, pivots, block).collect():
        got.setdefault(r["point"], {})[r["rank"]] = r["neighbour"]
    for i, v in rows:
        expected = sorted((math.dist(v, w), j) for j, w in rows if j != i)[:5]
        assert got[i] == {n + 1: j for n, (_, j) in enumerate(expected)}


def test_oversampling_with_many_copies(spark):
    """A third of the class is one repeated row; new rows lie between a row and a near one."""
    rng = random.Random(9)
    fraud = [(0.0, 0.0)] * 10 + [(rng.random() * 9, rng.random() * 9) for _ in range(20)]
    rows = [(i, x, y, 1) for i, (x, y) in enumerate(fraud)]
    rows += [(100 + i, 50.0, 50.0, 0) for i in range(1217)]
    train = spark.createDataFrame(rows, "transaction_id bigint, a double, b double, is_fraudulent int")
    out = O.oversample(train, ["a", "b"], "transaction_id").persist()
    sizes = {r["is_fraudulent"]: r["count"] for r in out.groupBy("is_fraudulent").count().collect()}
    assert sizes == {0: 1217, 1: 1217}
    assert out.select("transaction_id").distinct().count() == 2434
    made = out.filter(F.col("transaction_id").contains("~")).collect()
    per_point = {}
    for r in made:
        i = int(r["transaction_id"].split("~")[0])
        per_point[i] = per_point.get(i, 0) + 1
        start = fraud[i]
        near = sorted(math.dist(start, p) for j, p in enumerate(fraud) if j != i)[:5]
        assert math.dist(start, (r["a"], r["b"])) <= near[-1] + 1e-9
        if i == 0:
            assert (r["a"], r["b"]) == (0.0, 0.0)  # its five nearest are its own copies
    assert 390 <= per_point[0] <= 400 and all(39 <= n <= 40 for i, n in per_point.items() if i)


def test_oversampling_needs_two_classes(spark):
    one = spark.createDataFrame([(1, 0.0, 0)], "transaction_id bigint, a double, is_fraudulent int")
    with pytest.raises(ValueError):
        O.oversample(one, ["a"], "transaction_id")


SMALL = {
    "gbt": {"maxIter": 3, "maxDepth": 3},
    "rf": {"numTrees": 5, "maxDepth": 4},
    "mlp": {"epochs": 5},
}


@pytest.mark.parametrize("name,smote", [("gbt", False), ("rf", False), ("mlp", False), ("rf", True)])
def test_train_save_load_score(spark, features, tmp_path, name, smote):
    model = L.train(features, name, smote=smote, settings=SMALL[name])
    model = L.with_threshold(model, 0.25)
    L.save(model, str(tmp_path), name)
    again = L.load(spark, str(tmp_path), name)
    assert L.alert_threshold(again) == 0.25
    first = {r[0]: r[1] for r in L.score(model, features).select("transaction_id", "fraud_probability").collect()}
    second = {r[0]: r[1] for r in L.score(again, features).select("transaction_id", "fraud_probability").collect()}
    assert first == second and len(first) == 1000
    assert all(0 <= p <= 1 for p in first.values())


def test_evaluate_and_importances(spark, features, tmp_path):
    model = L.train(features, "rf", D.Options(include_status=True), settings=SMALL["rf"])
    table = V.evaluate_models({"rf": model}, features).persist()
    assert [r["kind"] for r in table.collect()] == ["default", "best"]
    write_metrics(table, str(tmp_path / "metrics"))
    assert spark.read.option("header", True).csv(str(tmp_path / "metrics")).count() == 2
    top = L.top_importances(model, spark, L.input_names(D.Options(include_status=True))).collect()
    assert len(top) == 20 and top[0]["importance"] >= top[-1]["importance"]
    assert V.best_threshold_of(model, features) in [r["threshold"] for r in table.collect()]


def test_unknown_and_missing_models(spark, features, tmp_path):
    with pytest.raises(ValueError):
        L.train(features, "nope")
    with pytest.raises(ValueError):
        L.load(spark, str(tmp_path), "nope")
    with pytest.raises(FileNotFoundError):
        L.load(spark, str(tmp_path), "gbt")


def test_trees_train_on_even_tasks(spark, monkeypatch):
    """However the feature table is cut, trees pass over tasks of equal size."""
    assert [L.even_tasks(n, 12) for n in (0, 500, 5_500, 4_800_000, 28_800_000)] == [1, 1, 6, 24, 120]
    seen = []

    class Spy:
        def fit(self, matrix):
            seen.extend(matrix.rdd.glom().map(len).collect())
            raise InterruptedError

    features = feature_table(Fixture(spark, "/root/testdata/sf0.01")).coalesce(1)
    monkeypatch.setattr(L, "estimator", lambda *_: Spy())
    with pytest.raises(InterruptedError):
        L.train(features, "rf")
    assert len(seen) == spark.sparkContext.defaultParallelism and max(seen) - min(seen) <= len(seen)


def test_neighbours_in_many_parts_and_shares(spark, monkeypatch):
    """Parts of cells and shares of a few points; odd vectors are near nothing; nothing is shipped per pair of blocks."""
    monkeypatch.setattr(O, "PART_POINTS", 30)
    monkeypatch.setattr(O, "SENT_BYTES", 3_000)
    rng = random.Random(6)
    vectors = [(rng.gauss(0, 1e6), float(rng.randrange(3)), rng.gauss(0, 1)) for _ in range(300)]
    vectors[10:20] = [(5e5, 1.0, float(i % 2)) for i in range(10)]  # ties, also at distance 0
    rows = [(f"p{i:03}", list(v)) for i, v in enumerate(vectors)]
    odd = [("n", [1.0, None, 2.0]), ("o", [math.nan, 1.0, 2.0]), ("q", [1.0, math.inf, 2.0])]
    df = spark.createDataFrame(rows + odd, "point string, vector array<double>")
    found = O.nearest_neighbours(df, 5, pivots=4, block_points=8)
    assert "CoGroups" not in found._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in found.collect():
        got.setdefault(r["point"], {})[r["rank"]] = (r["distance"], r["neighbour"])
    assert set(got) == {name for name, _ in rows}
    for i, v in rows:
        expected = sorted((math.dist(v, w), j) for j, w in rows if j != i)[:5]
        assert [got[i][n][1] for n in range(1, 6)] == [j for _, j in expected]
        assert np.allclose([got[i][n][0] for n in range(1, 6)], [d for d, _ in expected])


def test_neighbours_of_large_numbers_close_together(spark):
    """Squared distances made of products would lose all digits here."""
    x = np.random.default_rng(8).normal(size=(400, 3)) * 1e-3 + np.array([1e9, -1e9, 1e8])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "point bigint, vector array<double>")
    for r in O.nearest_neighbours(df, 3, pivots=3, block_points=40).filter("rank = 1").collect():
        apart = np.sqrt(((x - x[r["point"]]) ** 2).sum(axis=1))
        apart[r["point"]] = np.inf
        assert r["neighbour"] == apart.argmin() and r["distance"] == apart.min()


def test_made_rows_between_ends_that_are_copies(spark, tmp_path):
    """Equal rows with ids of different lengths: the smallest id as a number is not the smallest as text."""
    from tidemark.queries import REGISTRY

    for name in ("part", "customer", "supplier"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    copies = spark.range(3).selectExpr("id * 100000 as shift")
    events.crossJoin(copies).selectExpr(
        "event_id + shift as event_id", "ts", "user_id + 3 * shift as user_id", "event_type", "value", "props"
    ).write.parquet(f"{tmp_path}/events.parquet")
    (row,) = REGISTRY["u04_rows_between_named_ends"](spark, str(tmp_path)).collect()
    counted = REGISTRY["u04_oversampled_rows"](spark, str(tmp_path)).collect()
    known = {r["is_fraudulent"]: r["rows"] for r in counted if not r["is_made"]}
    assert all(r["rows"] == r["between"] for r in counted) and len(counted) == 3
    assert row.asDict() == {
        "made": known[0] - known[1],
        "between_ends": True,
        "ends_are_near": True,
        "starts_evenly": True,
    }
