"""Training-data operators: filters, deduplication, tokenisation and search on Spark.

One module per operator; ``queries`` registers the thin ``opN_`` queries.
Nothing outside this package imports it (the entry point adds it if present).
"""
