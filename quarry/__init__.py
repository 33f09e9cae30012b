"""quarry: dataset catalog, crawl and retrieval on Spark.

functions/  Column -> Column scalars      operators/  DataFrame -> DataFrame operators
sources/    scans and sinks               streaming/  Structured Streaming jobs
plans/      registered queries + oracles  session.py  session and lineage helpers
"""

__version__ = "0.1.0"
