"""Price models: properties that hold whatever the partitioning."""

import math
import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from fareflow import pricing
from fareflow.constants import CATEGORICAL_FEATURES

SCHEMA = (
    "airline string, source_city string, destination_city string, departure_time string, "
    "arrival_time string, duration_minutes int, stops int, days_left int, cabin_class string, price int"
)


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)

    def row():
        airline, cabin, days = rnd.choice("ABC"), rnd.choice(["Economy", "Business"]), rnd.randint(1, 49)
        price = 3000 + 9000 * (cabin == "Business") + 500 * "ABC".index(airline) - 20 * days + rnd.randint(0, 300)
        return (airline, rnd.choice("xy"), rnd.choice("xy"), "Morning", rnd.choice(["Night", "Evening"]),
                rnd.randint(50, 900), rnd.randint(0, 2), days, cabin, price)

    data = [row() for _ in range(600)] + [("A", None, "x", "Morning", "Night", 60, 0, 3, "Economy", 100)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def fitted(rows):
    return pricing.fit_models(rows, pricing.price_regressors(trees=5, rounds=3))


def test_leaderboard_is_ranked_by_rmse(fitted):
    board = fitted[1].orderBy("rank").collect()
    assert {r.model for r in board} == {"LinearRegression", "RandomForest", "GBT"}
    assert [r.rmse for r in board] == sorted(r.rmse for r in board)
    assert all(math.isfinite(v) for r in board for v in (r.rmse, r.mae, r.r2))
    assert board[0].r2 > 0.9


def test_a_large_table_in_one_part_is_trained_on_by_many_tasks(rows, monkeypatch):
    parts = {}

    class Watched(pricing.models.LinearRegression):
        def _fit(self, dataset):
            parts[len(parts)] = dataset.rdd.getNumPartitions()
            return super()._fit(dataset)

    regressors = {"LinearRegression": Watched(labelCol="price")}
    alone = pricing.fit_models(rows.coalesce(1), regressors)[1].first()
    monkeypatch.setattr(pricing.models, "TASK_ROWS", 100)
    dealt = pricing.fit_models(rows.coalesce(1), regressors)[1].first()
    assert parts == {0: 1, 1: 6}
    assert dealt.rmse == pytest.approx(alone.rmse, rel=1e-6)


def test_training_has_few_tasks_and_rows_in_the_order_of_their_features(rows, monkeypatch):
    seen = []

    class Watched(pricing.models.LinearRegression):
        def _fit(self, dataset):
            seen.append(dataset.rdd.map(lambda r: tuple(r.features.toArray()[-3:])).glom().collect())
            return super()._fit(dataset)

    monkeypatch.setattr(pricing.models, "TASK_ROWS", 10)
    pricing.fit_models(rows.coalesce(1), {"LinearRegression": Watched(labelCol="price")})
    monkeypatch.setattr(pricing.models, "TASK_ROWS", 2)
    pricing.fit_models(rows.coalesce(1), {"LinearRegression": Watched(labelCol="price")})
    assert [len(parts) for parts in seen] == [12, 30]
    assert sum(map(len, seen[0])) == sum(map(len, seen[1])) > 400
    assert all(part == sorted(part) for parts in seen for part in parts)


def test_metrics_equal_the_evaluator(fitted, rows):
    scored = pricing.score(fitted[0]["LinearRegression"], rows.dropna())
    ours = pricing.regression_metrics(scored).first()
    for name in ("rmse", "mae", "r2"):
        evaluator = RegressionEvaluator(labelCol="price", predictionCol="prediction", metricName=name)
        assert ours[name] == pytest.approx(evaluator.evaluate(scored), rel=1e-9)


def test_unseen_labels_are_scored_and_models_survive_storage(spark, fitted, rows, tmp_path):
    quotes = rows.dropna().limit(3).withColumn("airline", F.lit("Unseen")).drop("price")
    for name, model in fitted[0].items():
        pricing.save_model(model, f"{tmp_path}/{name}")
        pricing.save_model(model, f"{tmp_path}/{name}")
        loaded = pricing.load_model(f"{tmp_path}/{name}")
        before = [r.prediction for r in pricing.score(model, quotes, digits=2).collect()]
        after = [r.prediction for r in pricing.score(loaded, quotes, digits=2).collect()]
        assert before == after and all(p is not None and math.isfinite(p) for p in before)


def test_split_does_not_depend_on_partitions(rows):
    train, test = pricing.split_rows(rows)
    again = pricing.split_rows(rows.repartition(7))[0]
    assert train.count() + test.count() == rows.count()
    assert sorted(train.collect(), key=str) == sorted(again.collect(), key=str)
    assert 0.7 < train.count() / rows.count() < 0.9


def test_feature_width_is_labels_plus_numbers(rows):
    known = rows.dropna()
    vectors = pricing.feature_stages().fit(known).transform(known)
    # With kept unknowns and the last category dropped there is one slot per known label.
    labels = sum(known.select(c).distinct().count() for c in CATEGORICAL_FEATURES)
    assert len(vectors.first()["features"]) == labels + 3


def test_defaults_are_the_full_size_models():
    models = pricing.price_regressors()
    assert (models["RandomForest"].getNumTrees(), models["RandomForest"].getMaxDepth()) == (100, 10)
    assert (models["GBT"].getMaxIter(), models["GBT"].getMaxDepth(), models["GBT"].getStepSize()) == (100, 8, 0.1)
    assert models["GBT"].getSeed() == models["RandomForest"].getSeed() == 42
