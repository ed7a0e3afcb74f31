import random

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer
from pyspark.sql import functions as F

from naviscope.operators import evaluate, features, forest, models
from naviscope.schemas import FEATURE_NAMES
from naviscope.session import materialise


def labelled(spark, rows):
    names = ["num_crisil_rating", "num_family_aum", "num_scheme_aum", "num_latest_nav",
             "num_min_investment", "num_last_dividend", "num_bonus"]
    schema = "scheme_idx long, horizon string, is_train boolean, fund_ret double, ret_1m double, cat_avg double, cat_avg_first double, label double, label_bin int"
    df = spark.createDataFrame(rows, schema)
    nothing = [F.lit(None).cast("double").alias(n) for n in names]
    return df.select("*", F.lit(3).alias("num_scheme_risk"), *nothing)


def test_feature_modes(spark):
    rows = [
        (1, "3m", True, 4.0, 1.5, 4.0, 1.0, 0.0, 0),
        (2, "3m", True, None, 1.5, 0.0, 1.0, 0.0, 0),
        (3, "3m", True, 4.0, None, 4.0, None, 1.0, 1),
        (4, "1m", True, None, None, 2.0, 2.0, 1.0, 1),
    ]
    own = {r.scheme_idx: (r.f8, r.f9) for r in features.feature_rows(labelled(spark, rows)).collect()}
    assert own == {1: (4.0, 4.0), 2: (0.0, 0.0), 3: (4.0, 4.0), 4: (0.0, 2.0)}
    gated = features.feature_rows(labelled(spark, rows), "reference")
    found = {r.scheme_idx: (r.f8, r.f9) for r in gated.collect()}
    assert found == {1: (1.5, 1.0), 2: (0.0, 0.0), 3: (None, None), 4: (0.0, 2.0)}
    filled = {r.scheme_idx: r.f8 for r in features.impute_means(gated).collect()}
    assert filled == {1: 1.5, 2: 0.0, 3: 0.75, 4: 0.0}
    with pytest.raises(ValueError):
        features.feature_rows(labelled(spark, rows), "other")


def test_imputation_equals_the_library(spark):
    rng = random.Random(3)
    rows = [(i, "1y", i % 3 == 0, rng.choice([None, rng.random()])) for i in range(200)]
    df = spark.createDataFrame(rows, "scheme_idx long, horizon string, is_train boolean, f8 double")
    df = df.select("*", *[F.lit(1.0).alias(f) for f in features.FEATURES if f != "f8"])
    model = Imputer(inputCols=["f8"], outputCols=["out"]).fit(df.filter("is_train"))
    wanted = {r.scheme_idx: r.out for r in model.transform(df).collect()}
    found = {r.scheme_idx: r.f8 for r in features.impute_means(df, train_only=True).collect()}
    assert found == pytest.approx(wanted)


def test_balance_duplicates_and_thinning(spark, monkeypatch):
    rows = [(i, h, int(i % 10 == 0)) for h in ("1m", "3m") for i in range(1000)] + [(1, "5y", 0)]
    df = spark.createDataFrame(rows, "scheme_idx long, horizon string, label_bin int")
    even = {r.horizon: (r.good, r.total) for r in features.balance(features.duplicate_minority(df)).collect()}
    assert even == {"1m": (900, 1800), "3m": (900, 1800), "5y": (0, 1)}
    monkeypatch.setattr(features, "COPIES", 4)
    copies = features.duplicate_minority(df).filter("horizon = '1m' AND scheme_idx = 10").collect()
    assert sorted(r["copy"] for r in copies) == list(range(1, 10))
    thin = {r.horizon: (r.good, r.total) for r in features.balance(features.thin_majority(df, 0.25)).collect()}
    assert thin["1m"][0] == 100 and 250 < thin["1m"][1] < 400


def test_f1_and_precision(spark):
    rows = [("a", 1, 1)] * 3 + [("a", 1, 0)] + [("a", 0, 1)] * 2 + [("a", 0, 0)] * 4 + [("b", 0, 0)]
    df = spark.createDataFrame(rows, "g string, prediction int, label_bin int")
    f1 = {r.g: r.f1 for r in evaluate.f1_scores(df, ["g"]).collect()}
    assert f1 == {"a": pytest.approx(6 / 9), "b": 0.0}
    a = evaluate.precision_recall(df, ["g"]).filter("g = 'a'").first()
    assert (a.precision, a.recall) == (0.75, 0.6)


def test_box_plot_and_best(spark):
    rows = [("1m", 2, v) for v in (1.0, 2.0, 3.0, 4.0, 100.0)] + [("1m", 3, 22.0)] + [("1m", 1, 1.0)]
    df = spark.createDataFrame(rows, "horizon string, num_trees int, f1 double")
    box = evaluate.box_plot(df, ["num_trees"]).filter("num_trees = 2").first()
    assert tuple(box)[1:] == (2.0, 3.0, 4.0, 1.0, 4.0, 1)
    nameless = evaluate.box_plot(df.withColumn("horizon", F.lit(None).cast("string")), ["horizon"]).first()
    assert (nameless.horizon, nameless.whisker_low) == (None, 1.0)
    best = evaluate.best_tree_count(df).first()
    assert (best.num_trees, best.mean_f1) == (2, 22.0)


def test_folds_are_stratified_runs(spark):
    rows = [(i, "1m", int(i % 4 == 0)) for i in range(103)]
    df = spark.createDataFrame(rows, "scheme_idx long, horizon string, label_bin int").repartition(3)
    found = evaluate.add_folds(df, 10, chunk_rows=16).collect()
    for label in (0, 1):
        mine = sorted((r.scheme_idx, r.fold) for r in found if r.label_bin == label)
        sizes = [sum(f == k for _, f in mine) for k in range(10)]
        base, extra = divmod(len(mine), 10)
        assert sizes == [base + 1] * extra + [base] * (10 - extra)
        assert [f for _, f in mine] == sorted(f for _, f in mine)


@pytest.fixture(scope="module")
def stored(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        x = [rng.random() for _ in features.FEATURES]
        rows.append((i, "1m", i < 300, int(x[0] + 0.3 * x[8] + 0.2 * rng.random() > 0.9), *x))
    rows.append((999, "5y", True, 0, *[0.0] * 10))
    schema = "scheme_idx long, horizon string, is_train boolean, label_bin int, " + ", ".join(
        f"{f} double" for f in features.FEATURES
    )
    return forest.assemble(evaluate.add_folds(spark.createDataFrame(rows, schema), 3))


def test_forest(spark, stored):
    models = forest.fit_horizons(stored, max_depth=5)
    assert sorted(models) == ["1m", "5y"] and models["5y"].numClasses == 2
    shares = forest.importances(spark, models).filter("horizon = '1m'")
    assert sum(r.importance for r in shares.collect()) == pytest.approx(1)
    assert [r.feature for r in shares.collect()] == list(FEATURE_NAMES)
    assert forest.reported_importances(shares).count() == 8
    without = forest.predict(stored, {"1m": models["1m"]}).filter("horizon = '5y'").first()
    assert (without.prediction, without.probability) == (None, None)
    found = forest.predict(stored, models)
    again = forest.predict(stored, forest.fit_horizons(stored, max_depth=5))
    assert sorted(found.collect()) == sorted(again.collect())
    assert found.count() == 401
    assert found.filter("horizon = '5y'").first().prediction == 0
    score = evaluate.accuracy(found.filter("NOT is_train AND horizon = '1m'")).first()
    assert score.n_rows == 100 and score.majority_share < score.accuracy <= 1


def test_prefixes_end_at_the_whole_forest(stored):
    rows = stored.filter("horizon = '1m'")
    model = forest.fit(rows.filter("fold <> 0"), 12, max_depth=6)
    test = rows.filter("fold = 0")
    counts = forest.prefix_counts(model, test).filter("num_trees = 12")
    found = {(r.prediction, r.label_bin): r.n for r in counts.collect()}
    whole = model.transform(test).groupBy("prediction", "label_bin").count().collect()
    assert found == {(int(r[0]), int(r[1])): r[2] for r in whole}
    one = forest.fit(rows.filter("fold <> 0"), 12, max_depth=6).trees[0].transform(test)
    first = forest.prefix_counts(model, test).filter("num_trees = 1")
    assert {(r.prediction, r.label_bin): r.n for r in first.collect()} == {
        (int(r[0]), int(r[1])): r[2] for r in one.groupBy("prediction", "label_bin").count().collect()
    }


def test_trees_do_not_grow_with_the_rows(spark):
    rng = random.Random(4)

    def nodes(n):
        rows = [(i, "1m", True, rng.randint(0, 1), *[rng.random() for _ in features.FEATURES]) for i in range(n)]
        schema = "scheme_idx long, horizon string, is_train boolean, label_bin int, " + ", ".join(f"{f} double" for f in features.FEATURES)
        return forest.fit(forest.assemble(spark.createDataFrame(rows, schema)), 3, leaf_share=0.02).totalNumNodes

    assert nodes(10_000) < 1.5 * nodes(1_000)


def test_rows_keep_their_nodes_while_trees_grow(stored):
    rows = stored.filter("is_train AND horizon = '1m'")
    model = forest.fit(rows, 5, max_depth=8)
    assert model.getCacheNodeIds()
    led = RandomForestClassifier(featuresCol="features", labelCol="label_bin", numTrees=5, maxDepth=8, minWeightFractionPerNode=forest.LEAF_SHARE, seed=forest.SEED).fit(rows)
    assert [t.toDebugString.partition("\n")[2] for t in model.trees] == [t.toDebugString.partition("\n")[2] for t in led.trees]


def test_balanced_training_finds_more_good_rows(stored):
    def recall(balanced):
        found = forest.predict(stored, forest.fit_horizons(stored, balanced=balanced, max_depth=3))
        return evaluate.precision_recall(found.filter("is_train AND horizon = '1m'"), ["horizon"]).first().recall

    assert recall(True) >= recall(False)


def test_cross_validation(stored):
    frame = forest.cross_validate(stored, folds=3, max_trees=5, max_depth=4)
    best = evaluate.best_tree_count(frame).first()
    assert best.horizon == "1m" and 1 <= best.num_trees <= 5
    assert evaluate.box_plot(frame, ["horizon", "num_trees"]).count() == 5
    scores = frame.collect()
    assert {(r.horizon, r.num_trees, r.fold) for r in scores} == {
        ("1m", n, f) for n in range(1, 6) for f in range(3)
    }
    assert all(0 <= r.f1 <= 1 for r in scores) and max(r.f1 for r in scores) > 0.6


def test_roc(spark):
    rng = random.Random(2)
    rows = [("1m", round(rng.random(), 2), rng.randint(0, 1)) for _ in range(500)]
    df = spark.createDataFrame(rows, "horizon string, score double, label_bin int")
    found = {r.score: (r.tpr, r.fpr) for r in evaluate.roc_points(df).collect()}
    positives = sum(y for _, _, y in rows)
    for score, (tpr, fpr) in found.items():
        above = [y for _, s, y in rows if s >= score]
        assert tpr == pytest.approx(sum(above) / positives)
        assert fpr == pytest.approx((len(above) - sum(above)) / (len(rows) - positives))
    assert set(found) == {s for _, s, _ in rows}


def raw_features(spark):
    """Two horizons; missing features, one of them in every training row of a horizon, and a horizon of one class."""
    rng = random.Random(9)
    rows = []
    for i in range(400):
        for h in ("1m", "5y"):
            x = [None if rng.random() < 0.2 else rng.random() for _ in features.FEATURES]
            if h == "5y":
                x[3] = None if i < 300 else 1.0
            rows.append((i, h, i < 300, *x, int(h == "1m" and (x[0] or 0) > 0.5)))
    names = ", ".join(f"{f} double" for f in features.FEATURES)
    return spark.createDataFrame(rows, f"scheme_idx long, horizon string, is_train boolean, {names}, label_bin int")


def test_saved_pipelines_score_as_before(spark, tmp_path):
    rows = materialise(raw_features(spark), "raw-features")
    folder = str(tmp_path / "models")
    fitted = models.fit_and_save(rows, folder, trees={"1m": 5, "5y": 3})
    before = models.score(rows, fitted)
    assert before.columns == [*rows.columns, "prediction", "probability"] and before.count() == rows.count()
    again = models.score(rows, models.load(folder, ("1m", "5y")))
    assert sorted(before.collect(), key=str) == sorted(again.collect(), key=str)
    # Missing features are filled with the means of training rows, 0 where no training row has one.
    means = rows.where("is_train").groupBy("horizon").agg(*[F.avg(f).alias(f) for f in features.FEATURES])
    means = {r.horizon: r for r in means.collect()}
    for h, model in fitted.items():
        row = model.transform(rows.where((F.col("horizon") == h) & F.col("f0").isNull())).first()
        assert row["filled_f0"] == pytest.approx(means[h]["f0"])
    hidden = fitted["5y"].transform(rows.where("horizon = '5y' AND is_train")).first()
    assert hidden["filled_f3"] == 0
    right = before.where("horizon = '1m' AND prediction = label_bin").count()
    assert right > 360 and before.where("horizon = '5y' AND prediction = 1").count() == 0
    # A horizon without a model has no predictions; saving again replaces.
    some = models.score(rows, {"1m": fitted["1m"]})
    assert some.where("prediction IS NULL").count() == 400
    models.fit_and_save(rows.where("horizon = '1m'"), folder, trees={"1m": 2, "5y": 3})
    assert models.load(folder, ("1m",))["1m"].stages[-1].getNumTrees == 2
