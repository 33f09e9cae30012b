import json
import os

from pyspark.sql import functions as F

from quarry.operators import answers as an
from quarry.operators import collection as col
from quarry.operators import crawl as cr
from quarry.operators import pages as pg

HIT_SCHEMA = ("file_url string, file_ext string, page_url string, page_title string, page_description string, "
              "page_tags array<string>, anchor_text string, content_type string, content_length long, "
              "discovered_at string, data_collected_date string")


def test_file_hits_csv_and_jsonl(spark, tmp_dir):
    hits = spark.createDataFrame([
        ("http://h/a.csv", ".csv", "http://h/", "T", "D", ["x", "y"], "é data", "text/csv", None, "2024-01-01T00:00:00Z", None),
    ], HIT_SCHEMA)
    cr.write_file_hits(hits, os.path.join(tmp_dir, "hits"))
    c = spark.read.option("header", "true").csv(os.path.join(tmp_dir, "hits_csv")).first()
    assert c["page_tags"] == "x; y" and c["content_length"] is None and c["anchor_text"] == "é data"
    files = [f for f in os.listdir(os.path.join(tmp_dir, "hits_jsonl")) if f.endswith(".json")]
    lines = [json.loads(l) for f in files for l in open(os.path.join(tmp_dir, "hits_jsonl", f), encoding="utf-8")]
    assert lines[0]["page_tags"] == ["x", "y"] and lines[0]["content_length"] is None
    assert "data_collected_date" in lines[0]


def test_chunks_csv(spark, tmp_dir):
    pages = spark.createDataFrame([(1, "http://h/p", "<p>hello world</p>")], "page_id long, url string, html string")
    rows = pg.page_chunks(pg.extract_pages(pages))
    pg.write_chunks_csv(rows, os.path.join(tmp_dir, "chunks"))
    back = spark.read.option("header", "true").csv(os.path.join(tmp_dir, "chunks"))
    assert back.columns == list(pg.CHUNK_COLUMNS)
    assert back.first()["chunk_text"] == "hello world"


def test_chunk_files_store_a_repeated_description_once(spark, tmp_dir, monkeypatch):
    """A page without an end of its first paragraph has all its text in each chunk row's description."""
    from quarry.plans import registry

    text = lambda k: " ".join(f"word{(i * 7919 + k) % 10007}" for i in range(2000))
    spark.createDataFrame([(k, f"http://h/{k}", f"<title>a, \"b\"</title><p>{text(k)}\n<br>") for k in range(4)],
                          "page_id long, url string, html string").coalesce(1).write.parquet(os.path.join(tmp_dir, "pages.parquet"))
    monkeypatch.setattr(registry, "_scratch", lambda spark, name: os.path.join(tmp_dir, name))
    cols = list(pg.CHUNK_COLUMNS)
    got = registry.k3_chunks_csv(spark, tmp_dir).select(cols)
    want = registry.l2_page_chunks(spark, tmp_dir).select(*[F.col(c).cast("string") for c in cols])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 40
    written = sum(os.path.getsize(os.path.join(tmp_dir, "chunks", f)) for f in os.listdir(os.path.join(tmp_dir, "chunks")))
    assert written < 0.4 * got.select(F.sum(F.length("description"))).first()[0]


def test_vectors_roundtrip_and_subset(spark, tmp_dir):
    v = spark.createDataFrame([(str(i), [float(i), 1.0]) for i in range(10)], "id string, embedding array<float>")
    path = os.path.join(tmp_dir, "vectors")
    col.write_vectors(v, path)
    back = col.read_vectors(spark, path)
    ids = spark.createDataFrame([("3",), ("7",), ("99",)], "id string")
    assert sorted(r["id"] for r in col.subset(back, ids).collect()) == ["3", "7"]
    assert col.first_dimension(back) == 2


def test_audit_append_and_lookup(spark, tmp_dir):
    cat = spark.createDataFrame([("1", "Title one", "d", "A", "u", "t")],
                                "id string, title string, description string, agency string, api_url string, tags string")
    vec = spark.createDataFrame([("1", [1.0] + [0.0] * 63)], "id string, embedding array<double>")
    coll = col.build_collection(cat, vec)
    q = spark.createDataFrame([(1, "find data"), (2, "   ")], "qid long, query string")
    ans = an.answer_queries(q, coll, k=4)
    by = {r["qid"]: r for r in ans.collect()}
    assert by[2]["status"] == "blank" and by[2]["trust"]["score"] == 0.0 and by[2]["audit_id"] == ""
    assert by[1]["status"] == "ok" and len(by[1]["audit_id"]) == 8
    path = os.path.join(tmp_dir, "audit")
    an.append_audit(an.audit_records(ans), path, 0)
    for _ in range(2):  # the second is a replay
        an.append_audit(an.audit_records(ans), path, 1)
    audit = an.read_audit(spark, path, an.audit_records(ans).schema)
    assert audit.count() == 2  # the blank query is never logged
    ids = spark.createDataFrame([(by[1]["audit_id"],), ("nope",)], "audit_id string")
    found = {r["audit_id"]: r["found"] for r in an.audit_lookup(audit, ids).collect()}
    assert found["nope"] is False and found[by[1]["audit_id"]] is True


def test_generator_and_fallback(spark):
    cat = spark.createDataFrame([(str(i), f"T{i}", "d", "A", "u", "t") for i in range(5)],
                                "id string, title string, description string, agency string, api_url string, tags string")
    vec = spark.createDataFrame([(str(i), [float(i == j) for j in range(64)]) for i in range(5)],
                                "id string, embedding array<double>")
    coll = col.build_collection(cat, vec)
    q = spark.createDataFrame([(1, "alpha"), (2, "beta")], "qid long, query string")

    def gen(prompts):
        return ["We found 12% more data: 3 million rows." for _ in prompts]

    out = {r["qid"]: r for r in an.answer_queries(q, coll, generator=gen).collect()}
    assert out[1]["answer"] == "We found 12% more data: [data available] rows."
    assert out[1]["trust"]["factors"][0]["value"] == 1.0   # masked answer has no claim left

    def broken(prompts):
        raise RuntimeError("model down")

    out = {r["qid"]: r for r in an.answer_queries(q, coll, generator=broken).collect()}
    assert out[1]["answer"].startswith("I found 4 datasets related to 'alpha'")


def test_similar_by_id_reembed_and_unknown(spark):
    cat = spark.createDataFrame([(str(i), f"water report {i}" if i % 2 else f"road survey {i}", "d", "A", "u", "t")
                                 for i in range(8)],
                                "id string, title string, description string, agency string, api_url string, tags string")
    from quarry.operators.embed import embed
    vec = embed(cat.select("id", "title"), "title").select("id", "embedding")
    coll = col.build_collection(cat, vec)
    ids = spark.createDataFrame([("1",), ("2",), ("missing",)], "id string")
    out = {r["qid"]: r for r in an.similar_by_id(ids, coll, k=3, reembed=True, deterministic_audit=True).collect()}
    assert out["missing"]["status"] == "not_found" and out["missing"]["count"] == 0
    assert out["1"]["status"] == "ok" and out["1"]["count"] == 3
    assert all(h["id"] != "1" for h in out["1"]["hits"])           # self removed
    assert out["1"]["answer"].startswith("I found 3 datasets similar to '1'.")
    assert len(out["1"]["audit_id"]) == 8


def test_replayed_batches_search_their_answers_once(spark, monkeypatch):
    from quarry.plans import registry

    answered, real = spark.sparkContext.accumulator(0), registry._t8_answers

    def seen(text):
        answered.add(1)
        return text

    monkeypatch.setattr(registry, "_t8_answers", lambda spark, sf: (
        lambda a: a.withColumn("answer", F.udf(seen, "string").asNondeterministic()("answer")))(real(spark, sf)))
    got = registry.k6_replayed_batches(spark, "/root/testdata/sf0.001").collect()
    assert got and all(r["times"] == 1 for r in got) and answered.value == len(got)
