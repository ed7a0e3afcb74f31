"""Random forests per horizon: cross-validation, fit, importances, scoring.

Training and scoring run as Spark jobs on a feature table written once and
partitioned by horizon. The driver only starts the jobs of the horizons and
folds side by side and receives what is small by nature: one count row per
tree count, one importance per feature.
"""

import functools
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from naviscope.operators.evaluate import f1_scores
from naviscope.operators.features import FEATURES
from naviscope.schemas import CHOSEN_TREES, FEATURE_NAMES, SPARSE_FEATURES
from naviscope.session import materialise

# The learner's deepest setting comes closest to growing trees until leaves are pure. A leaf
# holds at least this share of the rows, which bounds a tree's leaves whatever their number.
MAX_DEPTH = 30
LEAF_SHARE = 0.002
SEED = 17
PARALLEL_FITS = 6


def assemble(rows, label="label_bin"):
    """Feature vector and numeric label, written once, one folder per horizon."""
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    # Both classes are declared: a horizon may have rows of one only.
    classes = {"ml_attr": {"type": "nominal", "name": label, "vals": ["0", "1"]}}
    vectors = vectors.withColumn(label, F.col(label).cast("double").alias(label, metadata=classes)).drop(*FEATURES)
    return materialise(vectors, "features", ["horizon"])


def class_counts(rows, label="label_bin"):
    """{horizon: (good, bad)} of rows to train on: one row per horizon reaches the driver."""
    counts = rows.groupBy("horizon").agg(F.sum(label).alias("good"), F.sum(1 - F.col(label)).alias("bad"))
    return {r.horizon: (r.good, r.bad) for r in counts.collect()}


def fit(train, num_trees, label="label_bin", max_depth=MAX_DEPTH, leaf_share=LEAF_SHARE, weight=None, seed=SEED):
    learner = RandomForestClassifier(
        featuresCol="features",
        labelCol=label,
        numTrees=num_trees,
        maxDepth=max_depth,
        minWeightFractionPerNode=leaf_share,
        # The trees are the same; a row keeps the node it is in and isn't led down each tree at every level.
        cacheNodeIds=True,
        seed=seed,
    )
    return (learner.setWeightCol(weight) if weight else learner).fit(train)


def side_by_side(task, items, parallelism):
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(task, items))


def prefix_counts(model, test, label="label_bin"):
    """(num_trees, tp, fp, fn) of the first n trees of a forest, for every n.

    A forest's first n trees are a forest of n trees, so one fit serves every
    tree count: add up the trees' class probabilities and compare to n / 2.
    """
    scored = test.select("features", label)
    # The trees' own Java objects: wrapping each in Python copies every parameter
    # one by one, which takes longer than scoring.
    frame, n = scored._jdf, 0
    for n, tree in enumerate(model._java_obj.trees(), start=1):
        tree.setPredictionCol("")
        tree.setRawPredictionCol("")
        tree.setProbabilityCol(f"p{n}")
        frame = tree.transform(frame)
    scored = DataFrame(frame, scored.sparkSession)
    votes = F.array(*[vector_to_array(f"p{i}")[1] for i in range(1, n + 1)])
    steps = scored.select(label, F.posexplode(_running(votes)).alias("pos", "sum"))
    steps = steps.selectExpr(
        f"int({label}) AS label_bin",
        "pos + 1 AS num_trees",
        "int(sum > (pos + 1) / 2D) AS prediction",
    )
    return steps.groupBy("num_trees", "prediction", "label_bin").agg(F.count(F.lit(1)).alias("n"))


def _running(values):
    """Running sums of a short array."""
    start = F.array().cast("array<double>")
    def add(sums, v):
        return F.concat(sums, F.array(F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0.0)) + v))
    return F.aggregate(values, start, add)


def cross_validate(stored, folds=10, max_trees=40, parallelism=PARALLEL_FITS, **options):
    """(horizon, num_trees, fold, f1) for 1..max_trees trees.

    `stored` comes from `assemble` and carries `fold`; only training rows count.
    One forest per horizon and fold, scored at every prefix of its trees. A fold that
    holds all rows of its horizon leaves none to train on and has no score.
    """
    spark = stored.sparkSession
    rows = stored.filter("is_train")
    sizes = {(r.horizon, r.fold): r["count"] for r in rows.groupBy("horizon", "fold").count().collect()}
    total = {h: sum(n for (g, _), n in sizes.items() if g == h) for h, _ in sizes}

    def one(job):
        horizon, fold = job
        mine = rows.filter(F.col("horizon") == horizon)
        model = fit(mine.filter(F.col("fold") != fold), max_trees, **options)
        counts = prefix_counts(model, mine.filter(F.col("fold") == fold))
        # Four counts per tree count.
        return [(horizon, r.num_trees, fold, r.prediction, r.label_bin, r.n) for r in counts.collect()]

    jobs = [(h, f) for h in sorted(total) for f in range(folds) if sizes.get((h, f), 0) < total[h]]
    found = [row for part in side_by_side(one, jobs, parallelism) for row in part]
    schema = "horizon string, num_trees int, fold int, prediction int, label_bin int, n long"
    counts = spark.createDataFrame(found, schema)
    return f1_scores(counts, ["horizon", "num_trees", "fold"], weight="n")


def fit_horizons(
    stored, trees=CHOSEN_TREES, balanced=False, parallelism=PARALLEL_FITS, **options
):
    """{horizon: model} on the training rows, with each horizon's tree count.

    `balanced` weighs the good rows so that both classes weigh the same. Every horizon
    with a training row has its forest, one class or two.
    """
    rows = stored.filter("is_train")
    counts = class_counts(rows)

    def one(horizon):
        mine, (good, bad) = rows.filter(F.col("horizon") == horizon), counts[horizon]
        if not balanced:
            return horizon, fit(mine, trees[horizon], **options)
        ratio = bad / good if good and bad else 1.0
        mine = mine.withColumn("weight", F.when(F.col("label_bin") == 1, ratio).otherwise(1.0))
        return horizon, fit(mine, trees[horizon], weight="weight", **options)

    return dict(side_by_side(one, sorted(counts), parallelism))


def importances(spark, models):
    """(horizon, feature, importance): ten rows per model."""
    rows = [
        (h, name, float(value))
        for h, model in models.items()
        for name, value in zip(FEATURE_NAMES, model.featureImportances.toArray())
    ]
    return spark.createDataFrame(rows, "horizon string, feature string, importance double")


def reported_importances(frame, left_out=SPARSE_FEATURES):
    return frame.filter(~F.col("feature").isin(*left_out))


def predict(stored, models):
    """All rows, training rows included, with `prediction` and `probability`.

    The rows keep the columns they were stored with, so that nothing has to be
    joined to them afterwards. A horizon without a model has null predictions.
    """
    kept = [c for c in stored.columns if c not in ("features", "label_bin")]

    def scored(rows, prediction, probability):
        return rows.select(*kept, F.col("label_bin").cast("int").alias("label_bin"), prediction.cast("int").alias("prediction"), probability.cast("double").alias("probability"))

    parts = [scored(stored.filter(~F.col("horizon").isin(*models)), F.lit(None), F.lit(None))]
    for horizon, model in models.items():
        rows = model.transform(stored.filter(F.col("horizon") == horizon))
        parts.append(scored(rows, F.col("prediction"), vector_to_array("probability")[1]))
    return functools.reduce(DataFrame.union, parts)
