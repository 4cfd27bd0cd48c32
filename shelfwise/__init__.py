"""shelfwise: retail analytics as lazy Spark DataFrame operators.

Layout
------
sources/    scans, fixture views, ingestion and sinks
functions/  Column-expression helpers (calendar, elapsed days, guarded maths)
operators/  lazy DataFrame -> DataFrame operators (features, inventory, pricing, ...)
plans/      end-to-end jobs and the query catalog wired into ``__spark_entry__``
streaming/  Structured Streaming ingestion with dead-letter split, windowed monitors
"""

__version__ = "0.1.0"
