"""Rule-based data validation (VQ-01..07).

The reference declares its rules in configuration and has no code for
them.  Here the same rules are data (``DEFAULT_RULES``) and each becomes a
boolean column; every report is one aggregate pass (``count_if`` per rule),
and the quarantine split is a filter on the same columns, so valid plus
quarantined always equals the input.  Nothing is collected to the driver.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Validation rules of the reference's ETL configuration.
DEFAULT_RULES = {
    "not_null": ["customer_id", "order_id", "product_id"],
    "types": {"order_value": "numeric", "quantity": "integer", "order_date": "datetime"},
    "range": {"order_value": (0, 100000), "quantity": (1, 1000)},
}
#: Column with the text of a record that could not be read, and the reason such a row gets.
CORRUPT, MALFORMED = "_corrupt_record", "malformed_record"
TYPE_TARGETS = {"numeric": "double", "integer": "bigint", "datetime": "timestamp_ntz"}


def _parsed(col: str, kind: str) -> Column:
    """Value parsed to the rule's type; NULL when it does not parse."""
    target = TYPE_TARGETS[kind]
    return F.col(col).cast("string").try_cast(target)


def rule_columns(rules: dict, parsed: dict[str, Column]) -> dict[str, Column]:
    """``{reason: Column(bool)}``: True where the row *breaks* the rule; ``parsed`` has the values of typed columns."""
    out: dict[str, Column] = {}
    for c in rules.get("not_null", []):
        out[f"null_{c}"] = F.col(c).isNull()
    for c in rules.get("types", {}):
        out[f"type_{c}"] = F.col(c).isNotNull() & parsed[c].isNull()
    for c, (lo, hi) in rules.get("range", {}).items():
        out[f"range_{c}"] = parsed[c].isNotNull() & ~parsed[c].between(lo, hi)
    return out


def not_null_report(df: DataFrame, columns: Sequence[str] = tuple(DEFAULT_RULES["not_null"])) -> DataFrame:
    """VQ-01: NULL count per column, one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "null_count")


def type_report(df: DataFrame, types: dict = DEFAULT_RULES["types"]) -> DataFrame:
    """VQ-02: values present but not parseable as the declared type, per column."""
    names = list(types)
    wide = df.agg(*[F.count_if(F.col(c).isNotNull() & _parsed(c, k).isNull()).alias(c) for c, k in types.items()])
    long = wide.unpivot([], names, "column_name", "invalid_count")
    kinds = F.create_map(*[x for c, k in types.items() for x in (F.lit(c), F.lit(k))])
    return long.withColumn("expected_type", kinds[F.col("column_name")])


def range_report(df: DataFrame, ranges: dict = DEFAULT_RULES["range"],
                 types: dict = DEFAULT_RULES["types"]) -> DataFrame:
    """VQ-03: values outside ``[min, max]`` (ends included), per column."""
    names = list(ranges)
    aggs = []
    for c, (lo, hi) in ranges.items():
        v = _parsed(c, types.get(c, "numeric"))
        aggs.append(F.count_if(v.isNotNull() & ~v.between(lo, hi)).alias(c))
    long = df.agg(*aggs).unpivot([], names, "column_name", "out_of_range_count")
    lows = F.create_map(*[x for c, (lo, _) in ranges.items() for x in (F.lit(c), F.lit(float(lo)))])
    highs = F.create_map(*[x for c, (_, hi) in ranges.items() for x in (F.lit(c), F.lit(float(hi)))])
    return long.withColumns({"min_value": lows[F.col("column_name")], "max_value": highs[F.col("column_name")]})


def with_reasons(df: DataFrame, rules: dict = DEFAULT_RULES, parsed: Sequence[str] = ()) -> DataFrame:
    """VQ-04: add ``dq_reasons`` (comma-separated broken rules, '' when valid) and ``is_valid``.

    Each field is parsed once and the rules become the bits of one number.  That column depends on the partition's number,
    for the optimiser only: such a column is neither written out again above nor moved below, so a filter on ``is_valid``
    doesn't parse the fields a second time, and only rejected rows get their reasons spelled out.  A row with text in
    ``_corrupt_record`` (``sources.readers``) is malformed, which is its only reason: its fields tell nothing.  The values of the
    ``parsed`` columns are kept as ``_dq_<column>``, so that a caller who types the rows doesn't parse them again.
    """
    types, ranges = rules.get("types", {}), rules.get("range", {})
    kinds = {c: types.get(c, "numeric") for c in [*types, *(c for c in ranges if c not in types)]}
    fields = df.withColumns({f"_dq_{c}": _parsed(c, kind) for c, kind in kinds.items()})
    broken = rule_columns(rules, {c: F.col(f"_dq_{c}") for c in kinds})
    bits = sum((F.when(cond, 1 << i).otherwise(0) for i, cond in enumerate(broken.values())), F.lit(0))
    if CORRUPT in df.columns:
        malformed = F.col(CORRUPT).isNotNull()
        bits = F.when(malformed, 1 << len(broken)).otherwise(bits)
        broken[MALFORMED] = malformed
    kept = [*df.columns, *(f"_dq_{c}" for c in parsed)]
    flagged = fields.select(*kept, F.when(F.spark_partition_id() >= 0, bits).alias("_dq"))
    reasons = F.concat_ws(",", *[F.when(F.col("_dq").bitwiseAND(F.lit(1 << i)) != 0, name) for i, name in enumerate(broken)])
    return flagged.select(*kept, reasons.alias("dq_reasons"), (F.col("_dq") == 0).alias("is_valid"))


def split_valid(df: DataFrame, rules: dict = DEFAULT_RULES) -> tuple[DataFrame, DataFrame]:
    """VQ-04: ``(valid, quarantined)``; quarantined rows keep their reasons, and malformed ones their text."""
    tagged = with_reasons(df, rules)
    return (tagged.filter(F.col("is_valid")).drop("dq_reasons", "is_valid", CORRUPT),
            tagged.filter(~F.col("is_valid")).drop("is_valid"))


def quality_score(df: DataFrame, rules: dict = DEFAULT_RULES) -> DataFrame:
    """VQ-05: rows, valid rows, quarantined rows and the share passing every rule."""
    return score(with_reasons(df, rules))


def score(tagged: DataFrame) -> DataFrame:
    """:func:`quality_score` of rows that :func:`with_reasons` has tagged."""
    return tagged.agg(F.count(F.lit(1)).alias("total_rows"),
                      F.count_if(F.col("is_valid")).alias("valid_rows"),
                      F.count_if(~F.col("is_valid")).alias("quarantined_rows"),
                      F.avg(F.when(F.col("is_valid"), 1.0).otherwise(0.0)).alias("quality_score"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """VQ-06: key combinations occurring more than once, with their counts (NULL keys grouped)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def run_metrics(df: DataFrame, name: str = "run") -> DataFrame:
    """VQ-07: rows, wall time and rows per second of one full pass over ``df``.

    The row count is gathered by an ``Observation`` riding on the job (no
    second pass); the result is a one-row DataFrame.
    """
    obs = Observation(name)
    t0 = time.perf_counter()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    dt = time.perf_counter() - t0
    rows = int(obs.get["rows"])
    spark = df.sparkSession
    return spark.createDataFrame([(name, rows, float(dt), float(rows / dt) if dt > 0 else None)],
                                 "run string, rows bigint, duration_s double, rows_per_s double")


def dataset_report(df: DataFrame, generated_at=None) -> DataFrame:
    """AG-19: row count, column names and generation time of a dataset (one row; by default the time of the run)."""
    when = F.current_timestamp() if generated_at is None else F.lit(generated_at)
    return df.agg(F.count(F.lit(1)).alias("total_records")).select(
        "total_records", F.array(*[F.lit(c) for c in df.columns]).alias("columns"), when.cast("timestamp_ntz").alias("generated_at"))
