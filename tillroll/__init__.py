"""tillroll: incremental retail-sales analytics on Spark.

Newly arrived sales files are read into a raw (bronze) layer, typed and
validated into a clean (silver) layer with per-line revenue, and the
reporting (gold) tables -- revenue by week, product, customer and country,
with top-k rankings -- are rebuilt from silver.  Everything is expressed with
built-in DataFrame / SQL / Structured Streaming operators.
"""

__version__ = "0.1.0"
