import json
import os

from pyspark.sql import functions as F

from quarry.operators import catalog as cat


def _write(d, name, text):
    p = os.path.join(d, name)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)


def test_unwrap_shapes_and_normalise(spark, tmp_dir):
    flow = lambda i, **kw: {"id": i, "name": f"N{i}", "agencyID": "AG", **kw}
    _write(tmp_dir, "a/data.json", json.dumps({"data": {"dataflows": [flow("A1"), flow("A2")]}}))
    for k in cat.FALLBACK_LIST_KEYS:
        _write(tmp_dir, f"b/{k}.json", json.dumps({k: [flow(f"{k}1")]}))
    _write(tmp_dir, "c/rootlist.json", json.dumps([flow("L1")]))
    _write(tmp_dir, "c/rootobj.json", json.dumps(flow("O1")))
    _write(tmp_dir, "c/empty.json", json.dumps({"data": {"dataflows": []}}))
    _write(tmp_dir, "c/bad.json", "{not json")
    _write(tmp_dir, "c/dup.json", '{"id": "D1", "name": "first", "name": "second"}')
    _write(tmp_dir, "c/nameslist.json", json.dumps([{"id": "X1", "names": ["en"]}, flow("X2")]))
    _write(tmp_dir, "c/noid.json", json.dumps([{"name": "no id", "agencyID": "AG"}]))
    _write(tmp_dir, "d/repeat1.json", json.dumps([flow("R1", name="one")]))
    _write(tmp_dir, "d/repeat2.json", json.dumps([flow("R1", name="two")]))
    _write(tmp_dir, "c/skip.txt", "[]")
    catalog, bad = cat.build_catalog(spark, tmp_dir)
    rows = {r["id"]: r.asDict() for r in catalog.collect()}
    expect = {"A1", "A2", "L1", "O1", "D1", "X2", "R1"} | {f"{k}1" for k in cat.FALLBACK_LIST_KEYS}
    assert expect <= set(rows)
    assert rows["D1"]["title"] == "second"          # last duplicate key wins
    assert rows["R1"]["title"] == "one"             # first file (path order) wins
    assert "X1" not in rows                          # names as a list: flow skipped
    noid = [r for k, r in rows.items() if k not in expect]
    # the empty list's wrapper counts as one flow of its own, without an id
    assert len(noid) == 2 and all(len(r["id"]) == 40 and r["api_url"] == "" for r in noid)
    assert sorted(r["title"] for r in noid) == ["", "no id"]
    assert rows["A1"]["api_url"].endswith("/A1") and rows["A1"]["agency"] == "AG"
    reasons = {r["reason"] for r in bad.collect()}
    assert reasons == {"not valid JSON", "flow skipped"}


def test_tags_and_freq(spark):
    long_part = "k" * 64
    ann = [
        {"type": "  ", "title": f"{long_part}=v,{'q' * 64},{'z' * 65}, FREQUENCY=q ", "text": "t" * 100},
        {"type": "B", "title": "same", "text": "same"},
        {"type": "C", "title": None, "text": "x" * 101},
    ]
    df = spark.createDataFrame([(ann,)], "annotations array<struct<type:string,title:string,text:string>>")
    from quarry.functions.catalog import collect_tags, infer_freq
    r = df.select(collect_tags("annotations").alias("t"), infer_freq("annotations").alias("f")).first()
    tags = r["t"]
    assert "" in tags                    # spaces-only type adds ''
    assert long_part in tags             # key of 64 kept; the part itself is 66 long: dropped
    assert f"{long_part}=v" not in tags
    assert "q" * 64 in tags and "z" * 65 not in tags
    assert "t" * 100 in tags and "x" * 101 not in tags
    assert "same" in tags and tags.count("same") == 1
    assert tags == sorted(tags)
    assert r["f"] == "quarterly"


def test_csv_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("1", "T, \"q\"", "d\nline", "AG", "", "annual", "u", "", "a;b")],
                               cat.CATALOG_SCHEMA)
    out = os.path.join(tmp_dir, "datasets")
    cat.write_catalog_csv(df, out)
    back = cat.read_catalog_csv(spark, os.path.join(tmp_dir, "missing"), out)
    r = back.first()
    assert r["title"] == "T, \"q\"" and r["description"] == "d\nline" and r["url"] is None


def test_keep_first_hot_key(spark):
    rows = [("hot", i, f"v{i}") for i in range(300)] + [("cold", 5, "c")]
    df = spark.createDataFrame(rows, "k string, pos int, v string")
    out = {r["k"]: r["v"] for r in cat.keep_first(df, "k", ["pos"]).collect()}
    assert out == {"hot": "v0", "cold": "c"}
