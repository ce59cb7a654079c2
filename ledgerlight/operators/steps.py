"""UD-01: user extension points as DataFrame transforms.

The reference leaves override hooks that return their input
(``process_data``, ``_apply_transformations``, ``_engineer_features``).  In
Spark a hook is any function ``DataFrame -> DataFrame``; chaining them with
``DataFrame.transform`` keeps the whole chain one lazy plan that Catalyst
optimises as a unit (no Python UDF, no materialisation between steps).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


def identity(df: DataFrame) -> DataFrame:
    """The reference's default hook: no change."""
    return df


def apply_steps(df: DataFrame, steps: Sequence[Step] = (identity,)) -> DataFrame:
    for step in steps:
        df = df.transform(step)
    return df
