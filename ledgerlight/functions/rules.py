"""Ordered rule lists folded into ``CASE WHEN`` columns.

The reference writes its scores and segments as searched CASE expressions
whose branches overlap, so *order matters* (first match wins).  Rules are
kept as ordered data and folded to one ``F.when`` chain, which stays a
single JVM expression inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    """Fold ``[(condition, value), ...]`` into ``CASE WHEN .. THEN .. ELSE default``."""
    expr = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if expr is None else expr.otherwise(d)


def score_at_most(col: str | Column, cuts: Sequence[float], scores: Sequence[int], default: int) -> Column:
    """Score by upper cuts: ``col <= cuts[i]`` gives ``scores[i]`` (recency style)."""
    c = F.col(col) if isinstance(col, str) else col
    return first_match([(c <= cut, s) for cut, s in zip(cuts, scores)], default)


def score_at_least(col: str | Column, cuts: Sequence[float], scores: Sequence[int], default: int) -> Column:
    """Score by lower cuts: ``col >= cuts[i]`` gives ``scores[i]`` (frequency / monetary style)."""
    c = F.col(col) if isinstance(col, str) else col
    return first_match([(c >= cut, s) for cut, s in zip(cuts, scores)], default)


def label_by_cuts(col: str | Column, cuts: Sequence[tuple[str, float, str]], default: str) -> Column:
    """Threshold labels ``[(op, cut, label)]`` with op in ``<=, <, >=, >``."""
    c = F.col(col) if isinstance(col, str) else col
    ops = {"<=": c.__le__, "<": c.__lt__, ">=": c.__ge__, ">": c.__gt__}
    return first_match([(ops[op](cut), label) for op, cut, label in cuts], default)


def segment(r: Column, f: Column, m: Column, rules: Sequence[tuple[tuple[str, int], tuple[str, int], tuple[str, int], str]],
            default: str) -> Column:
    """RFM segment from ordered rules ``((op, n) for R, F, M, label)``."""

    def cmp(c: Column, spec: tuple[str, int]) -> Column:
        op, n = spec
        return c >= n if op == ">=" else c <= n

    return first_match([(cmp(r, rs) & cmp(f, fs) & cmp(m, ms), label) for rs, fs, ms, label in rules], default)
