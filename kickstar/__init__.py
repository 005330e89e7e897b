"""kickstar — a Spark-native galaxy-schema (fact constellation) analytics engine.

Layers
------
* ``sources``   — staging CSV reader, audit columns, driver-table reader, sinks.
* ``functions`` — Column-level cleaning, banding, date and outcome expressions.
* ``operators`` — reject routing, lookups / anti-joins / role unpivot, de-duplication,
  grouping helpers, windows and top-n, surrogate keys.
* ``plans``     — the star shapes, measure registry, cube operators, KPIs, warehouse
  load (SCD merges, fact loads, incremental windows), data-quality checks and the
  named business questions.
* ``streaming`` — micro-batch form of the incremental, idempotent fact load.

Everything is expressed as DataFrame plans; no Python loops over rows.
"""

__version__ = "0.1.0"
