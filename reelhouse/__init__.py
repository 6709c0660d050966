"""reelhouse: a PySpark-native film analytics warehouse.

Layers (each a plain Python function over DataFrames, lazily planned by Catalyst):

* ``reelhouse.sources``   readers, writers, table catalog and the test-data adapter
* ``reelhouse.functions`` column expressions (keys, calendar tags, buckets, parsing)
* ``reelhouse.operators`` reusable DataFrame operators (cleaning, windows, joins,
  masking, access policy, quality rules)
* ``reelhouse.plans``     the warehouse models: bronze, dimensions, fact, views,
  reports and the end-to-end pipeline
"""

__version__ = "0.1.0"
