import pytest
from pyspark.sql import functions as F

from quarry.functions import trust as tr

HIT = "struct<id:string,title:string,description:string,agency:string,api_url:string,url:string,similarity_score:double>"


def _trust(spark, answer, hits):
    df = spark.createDataFrame([(answer, hits)], f"answer string, hits array<{HIT}>")
    df = df.withColumn("sources", tr.sources("hits"))
    f = tr.trust_factors(F.col("answer"), F.col("hits"), F.col("sources"))
    return df.select(tr.trust_struct(f, F.lit("x")).alias("t")).first()["t"]


def _hit(title, s):
    return ("1", title, "d", "a", "u", "", s)


def test_retrieval_jump(spark):
    low = _trust(spark, "ok", [_hit("T", 0.8999)])
    high = _trust(spark, "ok", [_hit("T", 0.90)])
    assert low["factors"][2]["value"] == round(0.8999, 3)
    assert high["factors"][2]["value"] == 1.0
    assert high["score"] == 1.0
    assert low["score"] == round(0.8999 ** 0.2, 3)


def test_no_hits_zero(spark):
    t = _trust(spark, "", [])
    assert t["score"] == 0.0
    assert [f["name"] for f in t["factors"]] == ["grounding", "provenance", "retrieval", "verification", "recency"]


def test_blank_first_title(spark):
    t = _trust(spark, "fine", [_hit("", 0.95), _hit("B", 0.95)])
    assert t["factors"][1]["value"] == 0.0 and t["score"] == 0.0


def test_mask_and_claims(spark):
    df = spark.createDataFrame([("Up 12% of all, 5 percent more, 3 million, 7%x",)], "a string")
    r = df.select(tr.mask_claims("a").alias("m"), tr.numeric_claims("a").alias("c")).first()
    assert r["c"] == ["5 percent", "3 million", "7%"]
    assert r["m"] == "Up 12% of all, 5 percent more, [data available], [data available]x"
    left = df.select(F.size(tr.numeric_claims(tr.mask_claims("a"))).alias("n")).first()["n"]
    assert left == 1  # '5 percent' survives masking, so grounding is 0
