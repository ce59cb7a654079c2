"""Registered ML queries (ML-01..04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ml as ML
from ..session import scratch_path
from ..sources import tables as T
from .catalog import register

FEATURES = ["quantity", "discount", "tax"]


def _split(spark, sf_dir):
    df = T.training_frame(spark, sf_dir)
    return ML.prepare_data(df, F.col("row_key"))


def _model(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    return ML.train_model(train, FEATURES)


@register("ml_split", ids=("ML-01",), doubles=["quantity", "discount", "tax", "target"], sql="""
WITH f AS (
    SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS row_key,
           l_quantity AS quantity, l_discount AS discount, l_tax AS tax
    FROM lineitem
)
SELECT row_key, quantity, discount, tax,
       100.0 * quantity - 500.0 * discount
           + (CAST(('0x' || substr(md5(row_key), 9, 4))::BIGINT AS DOUBLE) / 65535.0 - 0.5) * 10.0 AS target,
       CASE WHEN ('0x' || substr(md5(row_key), 1, 8))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS split
FROM f""")
def q_ml_split(spark, sf_dir):
    """Training frame with its stable 80/20 split label."""
    return ML.label_split(T.training_frame(spark, sf_dir), F.col("row_key"))


@register("ml_predict", ids=("ML-02",))
def q_ml_predict(spark, sf_dir):
    """Forest predictions for the held-out rows."""
    _, test = _split(spark, sf_dir)
    return ML.predict(_model(spark, sf_dir), test)


@register("ml_importance", ids=("ML-03",))
def q_ml_importance(spark, sf_dir):
    return ML.feature_importance(_model(spark, sf_dir), FEATURES)


@register("ml_evaluate", ids=("ML-04",))
def q_ml_evaluate(spark, sf_dir):
    _, test = _split(spark, sf_dir)
    return ML.evaluate_model(ML.predict(_model(spark, sf_dir), test))


FRAME = """
WITH keyed AS (
    SELECT *, concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS row_key FROM lineitem
),
frame AS (
    SELECT l_quantity AS quantity, l_discount AS discount, ('0x' || substr(md5(row_key), 1, 8))::BIGINT % 100 >= 80 AS held_out,
           100.0 * l_quantity - 500.0 * l_discount
               + (CAST(('0x' || substr(md5(row_key), 9, 4))::BIGINT AS DOUBLE) / 65535.0 - 0.5) * 10.0 AS target
    FROM keyed
)"""


@register("ml_evaluate_given", ids=("ML-04",), doubles=["mse", "r2_score"], sql=f"""{FRAME},
errors AS (SELECT target, target - (100.0 * quantity - 500.0 * discount) AS e FROM frame WHERE held_out),
centre AS (SELECT AVG(target) AS mean FROM errors)
SELECT COUNT(*) AS n, AVG(e * e) AS mse, 1.0 - SUM(e * e) / SUM((target - mean) * (target - mean)) AS r2_score FROM errors, centre""")
def q_ml_evaluate_given(spark, sf_dir):
    """MSE and R2 of a known prediction, the planted signal without its noise, for the held-out rows."""
    _, test = _split(spark, sf_dir)
    return ML.evaluate_model(test.withColumn("prediction", F.lit(100.0) * F.col("quantity") - F.lit(500.0) * F.col("discount")))


@register("ml_model_facts", ids=("ML-02", "ML-03"), sql=f"""{FRAME}
SELECT COUNT(*) AS n, 100 AS trees, ['discount', 'quantity', 'tax'] AS features, TRUE AS sums_to_one, 'quantity' AS strongest, TRUE AS explains
FROM frame WHERE held_out""")
def q_ml_model_facts(spark, sf_dir):
    """What is known of the forest beforehand: its size, that importances of the features sum to one, quantity leading, and
    that it explains over nine tenths of the held-out rows."""
    _, test = _split(spark, sf_dir)
    model = _model(spark, sf_dir)
    weights = ML.feature_importance(model, FEATURES).agg(
        F.array_sort(F.collect_list("feature")).alias("features"), (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"),
        F.max_by("feature", "importance").alias("strongest"))
    found = ML.evaluate_model(ML.predict(model, test)).select("n", (F.col("r2_score") > 0.9).alias("explains"))
    return found.join(weights, F.lit(True)).select("n", F.lit(model.stages[-1].getNumTrees).alias("trees"), "features", "sums_to_one", "strongest", "explains")


@register("ml_save_load", ids=("ML-05",), sql="""
SELECT COUNT(*) AS n, 0 AS n_different
FROM (SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS row_key FROM lineitem)
WHERE ('0x' || substr(md5(row_key), 1, 8))::BIGINT % 100 >= 80""")
def q_ml_save_load(spark, sf_dir):
    """Held-out rows, and how many the saved and reloaded forest predicts differently."""
    from pyspark.ml import PipelineModel

    train, test = _split(spark, sf_dir)
    model = ML.train_model(train, FEATURES)
    path = scratch_path(spark, "forest")
    ML.save_model(model, path)
    again = PipelineModel.load(path)
    both = again.transform(model.transform(test).drop("features").withColumnRenamed("prediction", "before"))
    return both.agg(F.count("*").alias("n"), F.count_if(F.col("prediction") != F.col("before")).cast("int").alias("n_different"))
