"""ledgerlight: Spark-native sales, customer and metric analytics.

Every operator is a function ``DataFrame -> DataFrame`` (plus plain
parameters) built from ``pyspark.sql.functions``; nothing is computed on
the driver.  Sub-packages:

- ``functions``  column-level helpers (calendar, rules, numeric)
- ``sources``    readers and test-data adapters
- ``sinks``      writers (partitioned facts, dimensions, reports)
- ``operators``  sales, customer, metric, feature, quality and ML operators
- ``plans``      composite chains and the registry of checkable queries
- ``streaming``  Structured Streaming forms (parse, debounce, KPIs)
"""

__version__ = "0.1.0"
