"""Model selection with ``pyspark.ml``: random forest over a parameter grid, cross-validated.

Preparation mirrors ``get_dummies(drop_first)`` + ``fillna(median)``: string columns are
indexed and one-hot encoded (one level dropped), numeric columns get their median
(``Imputer``), once for the whole table and outside the folds, like a frame prepared before the
search; the columns are written before they are prepared, the vectors after, and all fits read them. In every
round each task of a fit sends the statistics of every open node, so a fit gets a task for each
``TASK_ROWS`` rows, and no more tasks than cores: not one for each piece of a wide input. Rows keep the node they
have reached (``cacheNodeIds``), else each round goes down all trees again. Every model is trained by Spark on the whole
table; ``CrossValidator`` fits several settings at once (``parallelism``) and keeps none of them: the driver
holds ``parallelism`` forests at a time. sklearn's ``min_samples_leaf`` maps to
``minInstancesPerNode``; ``min_samples_split`` has no counterpart. Spark trees stop at
depth 30; deeper settings are refused.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewise.session import cut_lineage

MAX_SPARK_DEPTH = 30
TASK_ROWS = 32_768


def forest_grid_search(df: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str],
                       max_depth: Sequence[int] = (1, 2, 5, 10, 20, 30), min_leaf: Sequence[int] = (2, 3, 5),
                       folds: int = 5, num_trees: int = 20, seed: int = 42, parallelism: int = 2) -> DataFrame:
    """Mean and std of the cross-validated accuracy per setting:
    (param_max_depth, param_min_samples_leaf, mean_test_score, std_test_score, rank_test_score)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    cat, num = list(categorical), list(numeric)
    if max(max_depth) > MAX_SPARK_DEPTH:
        raise ValueError(f"Spark trees stop at depth {MAX_SPARK_DEPTH}")
    data = df.select(F.col(label).cast("double").alias("_label"), *cat, *[F.col(c).cast("double").alias(c) for c in num])
    data = cut_lineage(data, "forest-columns")
    idx = StringIndexer(inputCols=cat, outputCols=[f"{c}_idx" for c in cat], handleInvalid="keep",
                        stringOrderType="alphabetAsc")
    ohe = OneHotEncoder(inputCols=idx.getOutputCols(), outputCols=[f"{c}_ohe" for c in cat], dropLast=True)
    imp = Imputer(strategy="median", inputCols=num, outputCols=[f"{c}_imp" for c in num])
    vec = VectorAssembler(inputCols=ohe.getOutputCols() + imp.getOutputCols(), outputCol="_features")
    rf = RandomForestClassifier(labelCol="_label", featuresCol="_features", numTrees=num_trees, seed=seed, cacheNodeIds=True)
    grid = ParamGridBuilder().addGrid(rf.maxDepth, list(max_depth)).addGrid(rf.minInstancesPerNode, list(min_leaf)).build()
    prepared = Pipeline(stages=[idx, ohe, imp, vec]).fit(data).transform(data)
    tasks = max(1, min(math.ceil(data.count() / TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism))
    ready = cut_lineage(prepared.select("_label", "_features").repartition(tasks), "forest-features").coalesce(tasks)
    cv = CrossValidator(estimator=rf, estimatorParamMaps=grid,
                        evaluator=MulticlassClassificationEvaluator(labelCol="_label", metricName="accuracy"),
                        numFolds=folds, seed=seed, parallelism=parallelism)
    model = cv.fit(ready)
    rows = [(int(pm[rf.maxDepth]), int(pm[rf.minInstancesPerNode]), float(m), float(s))
            for pm, m, s in zip(grid, model.avgMetrics, model.stdMetrics)]
    out = df.sparkSession.createDataFrame(rows, "param_max_depth long, param_min_samples_leaf long, "
                                                "mean_test_score double, std_test_score double")
    # One row per setting (a handful): the unpartitioned window is over the grid, not the data.
    return out.withColumn("rank_test_score", F.rank().over(Window.orderBy(F.col("mean_test_score").desc())))
