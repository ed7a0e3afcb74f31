"""Models that outlive their session: one saved pipeline per horizon.

A pipeline fills missing features with the means of its training rows, assembles them and scores
them with a forest. Any later job loads it and scores raw feature rows.
"""

import functools

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from naviscope.operators.features import FEATURES
from naviscope.operators.forest import LEAF_SHARE, MAX_DEPTH, PARALLEL_FITS, SEED, side_by_side
from naviscope.schemas import CHOSEN_TREES, HORIZONS

FILLED = tuple(f"filled_{f}" for f in FEATURES)


def pipeline(num_trees, absent=(), label="label_bin", max_depth=MAX_DEPTH, leaf_share=LEAF_SHARE, seed=SEED):
    """The unfitted stages. Features that no training row has (`absent`) have no mean: 0 stands for it."""
    zeros = ", ".join(f"coalesce({f}, 0D) AS {f}" if f in absent else f for f in FEATURES)
    rest = "* EXCEPT (" + ", ".join(FEATURES) + ")"
    return Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT {rest}, {zeros} FROM __THIS__"),
            Imputer(strategy="mean", inputCols=list(FEATURES), outputCols=list(FILLED)),
            VectorAssembler(inputCols=list(FILLED), outputCol="features"),
            RandomForestClassifier(
                featuresCol="features", labelCol=label, numTrees=num_trees, maxDepth=max_depth, minWeightFractionPerNode=leaf_share, seed=seed
            ),
        ]
    )


def fit_and_save(rows, folder, trees=CHOSEN_TREES, parallelism=PARALLEL_FITS, label="label_bin", **options):
    """Fit a pipeline on each horizon's training rows and save it as `folder`/<horizon>; {horizon: model}.

    `rows` are stored feature rows, missing features included; a saved horizon is replaced.
    """
    train = rows.filter("is_train")
    known = train.groupBy("horizon").agg(*[F.count(f).alias(f) for f in FEATURES])
    absent = {r.horizon: [f for f in FEATURES if not r[f]] for r in known.collect()}
    # Both classes are declared: a horizon may have rows of one only.
    classes = {"ml_attr": {"type": "nominal", "name": label, "vals": ["0", "1"]}}

    def one(horizon):
        mine = train.filter(F.col("horizon") == horizon).withColumn(label, F.col(label).cast("double").alias(label, metadata=classes))
        model = pipeline(trees[horizon], absent[horizon], label, **options).fit(mine)
        model.write().overwrite().save(f"{folder}/{horizon}")
        return horizon, model

    return dict(side_by_side(one, sorted(absent), parallelism))


def load(folder, horizons=tuple(HORIZONS)):
    """{horizon: model} of saved pipelines; `horizons` names those that were saved."""
    return {h: PipelineModel.load(f"{folder}/{h}") for h in horizons}


def score(rows, models):
    """Feature rows with `prediction` and `probability`; a horizon without a model has nulls."""
    kept = rows.columns

    def scored(part, prediction, probability):
        return part.select(*kept, prediction.cast("int").alias("prediction"), probability.cast("double").alias("probability"))

    parts = [scored(rows.filter(~F.col("horizon").isin(*models)), F.lit(None), F.lit(None))]
    for horizon, model in models.items():
        # The label isn't read, but a forest wants its type.
        found = model.transform(rows.filter(F.col("horizon") == horizon))
        parts.append(scored(found, F.col("prediction"), vector_to_array("probability")[1]))
    return functools.reduce(DataFrame.unionByName, parts)
