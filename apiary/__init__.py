"""apiary: sensor and card-transaction analytics on Spark DataFrames.

Subpackages:

* ``functions``: column expressions (calendar buckets, reading values, ids,
  transaction flag and calendar split, basket text);
* ``operators``: DataFrame → DataFrame operators (ingest, joins, aggregates,
  summaries, windows, upserts, retention, transactions, range lookup);
* ``sources``: message and table readers and writers;
* ``streaming``: Structured Streaming pipelines built on the operators;
* ``plans``: the named queries over the test tables and their oracles.
"""

__version__ = "0.1.0"
