"""Random-forest regression pipeline (ML-01..05) on Spark ML.

The reference trains scikit-learn's forest on one machine.  Here training
is Spark ML's distributed forest: each tree level is one pass computing
split statistics per partition and merging them, so the data never leaves
the executors.  Forest defaults differ (Spark grows depth-5 trees over
binned features where scikit-learn grows full-depth exact trees), so the
two give close but not identical predictions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values from the reference's pipeline: test share, seed, forest size.
TEST_PERCENT = 20
SEED = 42
NUM_TREES = 100
#: Training rows a task: at most the first, and about the second where that gives fewer than ``SPREAD`` tasks.
#: The forest keeps about 500 bytes of a row (its count in each of 100 trees) and works it through every tree.
TASK_ROWS, SMALL_TASK_ROWS, SPREAD = 500_000, 50_000, 64


def split_bucket(key: Column) -> Column:
    """A stable 0..99 bucket from the row key (md5; a NULL key as empty text), independent of partitioning."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def label_split(df: DataFrame, key: Column, test_percent: int = TEST_PERCENT, name: str = "split") -> DataFrame:
    """ML-01 as a column: every row's ``train`` or ``test``, in one pass."""
    return df.withColumn(name, F.when(split_bucket(key) < 100 - test_percent, "train").otherwise("test"))


def prepare_data(df: DataFrame, key: Column, test_percent: int = TEST_PERCENT) -> tuple[DataFrame, DataFrame]:
    """ML-01: ``(train, test)``, 80/20 by a hash of the key.

    ``randomSplit`` would depend on the partition layout; a key hash gives the
    same split on any cluster and in SQL.
    """
    tagged = df.withColumn("_bucket", split_bucket(key))
    cut = 100 - test_percent
    return (tagged.filter(F.col("_bucket") < cut).drop("_bucket"),
            tagged.filter(F.col("_bucket") >= cut).drop("_bucket"))


def spread(train: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``columns`` of all rows, dealt evenly to tasks by their count alone, whatever the layout of the files.

    A file of one row group is otherwise one task, whose rows in all trees one core has to hold and to work through.
    Rows of a task are sorted by ``order``, so that neighbours take the same way through a tree and add to the
    same bins.  Few rows stay where they are.
    """
    train = train.select(*dict.fromkeys(columns))
    rows = train.count()
    tasks = max(-(-rows // TASK_ROWS), min(SPREAD, -(-rows // SMALL_TASK_ROWS)))
    return train if tasks < 2 else train.repartition(tasks).sortWithinPartitions(*order)


def train_model(train: DataFrame, features: Sequence[str], target: str = "target",
                num_trees: int = NUM_TREES, seed: int = SEED, feature_steps: Sequence = (), **forest) -> PipelineModel:
    """ML-02: assemble features and fit a random forest regressor.

    ``feature_steps`` are Spark ML stages that run before the assembler, in training and prediction
    alike (the hook for engineered features).
    """
    if not feature_steps:  # their inputs aren't known
        train = spread(train, [*features, target], features)
    asm = VectorAssembler(inputCols=list(features), outputCol="features")
    rf = RandomForestRegressor(featuresCol="features", labelCol=target, numTrees=num_trees, seed=seed,
                               featureSubsetStrategy=forest.pop("featureSubsetStrategy", "all"), **forest)
    return Pipeline(stages=[*feature_steps, asm, rf]).fit(train)


def feature_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """ML-03: importance per feature name (one row per feature)."""
    rf = model.stages[-1]
    spark = SparkSession.active()
    rows = [(name, float(v)) for name, v in zip(features, rf.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double")


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("features")


def evaluate_model(predictions: DataFrame, target: str = "target", prediction: str = "prediction") -> DataFrame:
    """ML-04: MSE and R2 as one distributed aggregate (one row)."""
    y, p = F.col(target), F.col(prediction)
    sums = predictions.agg(F.count(F.lit(1)).alias("n"),
                           F.sum((y - p) * (y - p)).alias("sse"),
                           F.avg(y).alias("mean_y"),
                           F.var_pop(y).alias("var_y"))
    return sums.select("n", (F.col("sse") / F.col("n")).alias("mse"),
                       (F.lit(1.0) - F.col("sse") / (F.col("var_y") * F.col("n"))).alias("r2_score"))


def save_model(model: PipelineModel, path: str) -> None:
    """ML-05: persist the fitted pipeline (loadable with ``PipelineModel.load``)."""
    model.write().overwrite().save(path)
