"""Shared SQL fragments for the DuckDB oracle queries.

The oracle restates each operator in plain SQL over the same parquet tables
(registered as views named after the tables).  The fragments below are the
SQL forms of the test-data adapters and of the numeric conventions used by
the registry; rule tables are in ``oracle_rules``.
"""

from __future__ import annotations

SALES_AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-01-31"

STAGING_SALES = """
staging_sales AS (
    SELECT o.o_orderkey AS order_id,
           o.o_custkey AS customer_id,
           l.l_partkey AS product_id,
           o.o_orderdate AS order_date,
           l.l_extendedprice * 0.02 AS order_value,
           CAST(trunc(l.l_quantity) AS INTEGER) AS quantity,
           l.l_extendedprice * 0.02 * l.l_discount AS discount,
           CASE o.o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
                                WHEN 'P' THEN 'cancelled' END AS status
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

CUSTOMER_ORDERS = """
customer_orders AS (
    SELECT o.o_custkey AS customer_id,
           o.o_orderkey AS order_id,
           o.o_orderdate AS order_date,
           (o.o_orderkey * 7919) % 86400 AS order_time,
           l.l_extendedprice * 0.002 AS order_value,
           p.p_type AS product_category,
           o.o_orderpriority AS payment_method
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                    JOIN part p ON l.l_partkey = p.p_partkey
)"""

METRICS_EVENTS = """
metrics_events AS (
    SELECT event_id AS id,
           event_type AS metric_name,
           value AS metric_value,
           CASE event_type WHEN 'purchase' THEN 'Financial' WHEN 'view' THEN 'Traffic'
                           WHEN 'signup' THEN 'Marketing' ELSE 'User Behavior' END AS category,
           event_type AS subcategory,
           props AS metadata,
           ts AS created_at,
           ts AS updated_at
    FROM events
)"""

METRICS_ORDERS = """
metrics_orders AS (
    SELECT o_orderkey AS id,
           'order_value' AS metric_name,
           o_totalprice / 100 AS metric_value,
           o_orderpriority AS category,
           o_orderstatus AS subcategory,
           o_orderdate AS created_at
    FROM orders
)"""


def rnd(expr: str, digits: int) -> str:
    """``ROUND`` of a number with ten exact decimals; numbers too large for that stay as they are."""
    return f"coalesce(CAST(round(TRY_CAST({expr} AS DECIMAL(38, 10)), {digits}) AS DOUBLE), {expr})"


def settle(sql: str, doubles: list[str], bits: int = 20) -> str:
    """SQL twin of ``numeric.settle_doubles`` for the listed DOUBLE columns."""
    if not doubles:
        return sql
    k = f"{2 ** bits}.0::DOUBLE"
    rep = ", ".join(f"round_even(CAST({c} AS DOUBLE) * {k}, 0) / {k} AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS settled"


def whole_days(as_of: str, col: str) -> str:
    return f"CAST(extract(day FROM (DATE '{as_of}' - ({col}))) AS INTEGER)"
