"""tradewind: daily market series joined with news text, on Spark.

Every public function takes and returns DataFrames.  Subpackages:

* ``sources``   - landed feed files, price history, dimension tables
* ``functions`` - column-level text, date and JSON expressions
* ``operators`` - reusable relational building blocks (windows, as-of,
                  aggregates, upserts, dedup, quality rules)
* ``plans``     - the jobs: features, article scoring, models, monitoring,
                  serving queries and the daily run
* ``streaming`` - Structured Streaming versions of ingest and aggregation
"""

__all__ = ["session", "bindings", "numerics"]
