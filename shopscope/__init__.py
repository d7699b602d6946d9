"""shopscope: retail customer analytics as Spark jobs.

* :mod:`shopscope.sources` - logical input schemas, readers, fixture mapping
* :mod:`shopscope.functions` - column-level rules and date helpers
* :mod:`shopscope.operators` - the report operators (DataFrame in, DataFrame out)
* :mod:`shopscope.plans` - registered queries and end-to-end jobs
* :mod:`shopscope.sinks` - CSV exports and segment routing
* :mod:`shopscope.streaming` - incremental daily app counters
* :mod:`shopscope.checks` - oracle SQL and result comparison
"""

__version__ = "0.1.0"
