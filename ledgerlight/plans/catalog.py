"""Registry of checkable queries: each pairs a Spark plan with its SQL restatement.

``register`` records, per key, the Spark callable ``(spark, sf_dir) ->
DataFrame``, the DuckDB SQL text (or ``None`` for operators that SQL cannot
state, which then get a rows-only check plus their own pytest), and the
names of the DOUBLE output columns, which both sides snap to a 2^-20 grid
with the same IEEE formula before comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.numeric import settle_doubles
from .sqltext import settle


@dataclass
class Entry:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: list[str] = field(default_factory=list)
    survey_ids: tuple[str, ...] = ()


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, doubles: tuple[str, ...] | list[str] = (),
             ids: tuple[str, ...] = ()):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query key {name}")
        REGISTRY[name] = Entry(name, fn, sql, list(doubles), ids)
        return fn
    return deco


def spark_callable(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return settle_doubles(entry.build(spark, sf_dir))
    run.__name__ = entry.name
    run.__doc__ = entry.build.__doc__
    return run


def load_all() -> dict[str, Entry]:
    # Importing the query modules fills REGISTRY.
    from . import (customer_queries, feature_queries, io_queries, metric_queries,  # noqa: F401
                   ml_queries, quality_queries, sales_queries, stream_queries)
    return REGISTRY


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: spark_callable(e) for k, e in load_all().items()}


def oracle_sql() -> dict[str, str]:
    return {k: settle(e.sql, e.doubles) for k, e in load_all().items() if e.sql is not None}
