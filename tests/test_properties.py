from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import trust as tr
from quarry.functions import urls as ux
from quarry.operators import catalog as cat

HIT = "struct<id:string,title:string,description:string,agency:string,api_url:string,url:string,similarity_score:double>"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.floats(-2, 2, allow_nan=False), min_size=0, max_size=4), min_size=1, max_size=6),
       st.sampled_from(["plain", "5 percent up", "12% of", "3 million"]))
def test_trust_score_in_unit_interval(spark, sims, answer):
    rows = [(answer, [("1", f"t{j}" if j else "", "", "", "", "", s) for j, s in enumerate(h)]) for h in sims]
    df = spark.createDataFrame(rows, f"answer string, hits array<{HIT}>").withColumn("sources", tr.sources("hits"))
    f = tr.trust_factors(F.col("answer"), F.col("hits"), F.col("sources"))
    out = df.select(tr.trust_struct(f, F.lit("a")).alias("t")).collect()
    for r in out:
        assert 0.0 <= r["t"]["score"] <= 1.0
        assert all(0.0 <= x["value"] <= 1.0 for x in r["t"]["factors"])


URLS = st.builds(lambda host, path, q, frag: f"http://{host}/{path}" + (f"?{q}" if q else "") + (f"#{frag}" if frag else ""),
                 st.sampled_from(["a.gov.au", "b.example.org:8080", "u@c.net"]),
                 st.text(alphabet="abc/._-", max_size=8),
                 st.lists(st.tuples(st.sampled_from(["utm_source", "x", "Gclid", "k", "sp ace"]),
                                    st.text(alphabet="ab c%+*~", max_size=4)), max_size=3)
                 .map(lambda kv: "&".join(f"{k}={v}" for k, v in kv)),
                 st.text(alphabet="xyz", max_size=3))


@settings(max_examples=10, deadline=None)
@given(st.lists(URLS, min_size=1, max_size=5))
def test_canonical_is_idempotent(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(ux.canonical("u").alias("c"))
    twice = df.select("c", ux.canonical("c").alias("cc")).collect()
    assert all(r["c"] == r["cc"] for r in twice)
    assert all("#" not in r["c"] and "utm_" not in r["c"].lower() for r in twice)


def test_normalise_is_idempotent(spark):
    flows = spark.createDataFrame(
        [("p", i, f" id{i % 3} " if i % 4 else "", f"  name {i}", None, None, None, "AG" if i % 2 else None,
          [("T", f"FREQUENCY=M, k{i}=v", "note")]) for i in range(12)],
        "path string, pos long, native_id string, name string, names_en string, description string, "
        "descriptions_en string, agency_id string, annotations array<struct<type:string,title:string,text:string>>")
    once = cat.keep_first(cat.normalise(flows), "id", ["path", "pos"])
    again = once.select("path", "pos", F.col("id").alias("native_id"), F.col("title").alias("name"),
                        F.lit(None).cast("string").alias("names_en"), "description",
                        F.lit(None).cast("string").alias("descriptions_en"), F.col("agency").alias("agency_id"),
                        F.lit(None).cast(cat.ANNOTATIONS_TYPE).alias("annotations"))
    twice = cat.normalise(again)
    a = {r["id"]: (r["title"], r["agency"]) for r in once.collect()}
    b = {r["id"]: (r["title"], r["agency"]) for r in twice.collect()}
    assert a == b
