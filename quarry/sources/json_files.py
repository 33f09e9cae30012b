"""A1: JSON files as rows of VARIANT (one row per file)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def _json_last_key_wins(s: pd.Series) -> pd.Series:
    """Re-serialise JSON that Spark rejects only for duplicate keys (Python keeps the last)."""
    def one(x):
        if x is None:
            return None
        try:
            return json.dumps(json.loads(x))
        except Exception:
            return None
    return s.map(one)


def read_json_files(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """A1: a file or a folder (recursive); one row per file: ``path, json`` (VARIANT).

    Bytes that are not UTF-8 are dropped; text that is not JSON gives a NULL
    ``json`` (the caller routes those rows to a quarantine output).
    """
    # replacement characters stand for bytes that are no UTF-8; they are dropped
    text = F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "\ufffd", "")
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", glob).load(path).select("path", text.alias("text"))
    parsed = raw.withColumn("json", F.try_parse_json("text"))
    # Spark rejects duplicate keys; Python keeps the last one.  Only the texts that Spark
    # rejects are passed to the function, all others as NULL.
    again = _json_last_key_wins(F.when(F.col("json").isNull(), F.col("text")))
    return parsed.withColumn("json", F.coalesce("json", F.try_parse_json(again))).select("path", "json")
