import os

from pyspark.sql import functions as F

from quarry.operators import pages as pg
from quarry.streaming import streams as zs

SF = "/root/testdata/sf0.001"


def test_chunk_stream_equals_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "pages_in")
    spark.read.parquet(f"{SF}/pages.parquet").repartition(4).write.parquet(src)  # several arriving files
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = spark.read.parquet(zs.run_available_now(zs.chunk_stream(stream), os.path.join(tmp_dir, "z1")))
    batch = pg.page_chunks(pg.extract_pages(spark.read.parquet(src)))
    cols = list(pg.CHUNK_COLUMNS)
    assert sorted(map(tuple, out.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))


def test_dedupe_stream_without_expiry_equals_distinct(spark, tmp_dir):
    src = os.path.join(tmp_dir, "ev")
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    d = zs.dedupe_stream(stream, ["user_id", "event_type"], "ts", delay=None)
    q = d.writeStream.format("memory").queryName("z2_all").outputMode("append").trigger(availableNow=True) \
        .option("checkpointLocation", os.path.join(tmp_dir, "z2c")).start()
    q.awaitTermination()
    got = spark.sql("SELECT user_id, event_type FROM z2_all").distinct().count()
    n = spark.sql("SELECT count(*) FROM z2_all").first()[0]
    exp = spark.read.parquet(src).select("user_id", "event_type").distinct().count()
    assert got == exp == n


def test_dedupe_stream_on_canonical_urls(spark, tmp_dir):
    import datetime as dt

    rows = [("http://h.gov.au/a?utm_source=x", dt.datetime(2024, 1, 1, 0, 0)),
            ("http://h.gov.au/a#top", dt.datetime(2024, 1, 1, 0, 5)),
            ("http://h.gov.au/a", dt.datetime(2024, 1, 1, 0, 6)),
            ("http://h.gov.au/b", dt.datetime(2024, 1, 1, 0, 7))]
    src = os.path.join(tmp_dir, "links")
    spark.createDataFrame(rows, "url string, ts timestamp").write.parquet(src)
    stream = spark.readStream.schema("url string, ts timestamp").parquet(src)
    d = zs.dedupe_stream(stream, ["url"], "ts", delay="1 hour", canonical_url="url")
    q = d.writeStream.format("memory").queryName("z2_urls").outputMode("append").trigger(availableNow=True) \
        .option("checkpointLocation", os.path.join(tmp_dir, "z2u")).start()
    q.awaitTermination()
    got = sorted(r["url"] for r in spark.sql("SELECT url FROM z2_urls").collect())
    assert got == ["http://h.gov.au/a", "http://h.gov.au/b"]


def test_expiring_dedupe_forgets_keys_and_drops_late_rows(spark, tmp_dir):
    import datetime as dt

    day = lambda d, h=0: dt.datetime(2024, 1, 1 + d, h)
    batches = [
        [("a", day(0)), ("a", day(0, 5)), ("b", day(0, 1))],
        [("a", day(0, 23)), ("b", day(2)), ("c", day(2))],  # a: within a day of the kept row; b: after it
        [("a", day(2, 1)), ("d", day(6)), (None, day(6)), (None, day(6, 1))],
        [("b", day(1)), ("d", day(6, 23)), ("e", day(6, 23))],  # b: later than the watermark
        [("d", day(7, 1)), ("f", day(9)), ("f", None)],
    ]
    src = os.path.join(tmp_dir, "late")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "key string, ts timestamp").coalesce(1).write.parquet(f"{src}/part={i}")
        for name in os.listdir(f"{src}/part={i}"):  # files are taken by age
            os.utime(f"{src}/part={i}/{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema("key string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    q = zs.expiring_dedupe(stream, ["key"], "ts", "1 day", "0 seconds").writeStream.format("memory").queryName("z2_late") \
        .outputMode("append").trigger(availableNow=True).option("checkpointLocation", os.path.join(tmp_dir, "z2l")).start()
    q.awaitTermination()
    got = sorted(((r["key"] or ""), r["ts"]) for r in spark.sql("SELECT * FROM z2_late").collect())
    assert got == [("", day(6)), ("a", day(0)), ("a", day(2, 1)), ("b", day(0, 1)), ("b", day(2)), ("c", day(2)),
                   ("d", day(6)), ("d", day(7, 1)), ("e", day(6, 23)), ("f", day(9))]
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert held == [2, 3, 5, 3, 4, 1]  # seven keys: a, b and c go in the fourth batch; at the end f alone is left


def test_keys_that_share_a_state_pass_as_if_alone(spark, tmp_dir):
    """Many keys, some null, far fewer calls of Python than keys; the rows that pass are those of each key alone."""
    import random

    rnd, hour = random.Random(5), 3_600_000_000
    big = 2**53 + 1  # not a number that pandas holds beside nulls
    keys = [(u, e) for u in (None, 0, 7, big, big + 1, *range(100, 140)) for e in (None, "a", 'q"u', "é")]
    rows = [(*k, 1_700_000_000_000_000 + rnd.randrange(200 * hour)) for k in keys for _ in range(12)]
    src = os.path.join(tmp_dir, "shared")
    for i in range(4):
        some = [r for r in rows if i <= (r[2] - 1_700_000_000_000_000) // (50 * hour) < i + 1]
        spark.createDataFrame(some, "u long, e string, us long").selectExpr("u", "e", "timestamp_micros(us) AS ts") \
            .coalesce(1).write.parquet(f"{src}/part={i}")
        for name in os.listdir(f"{src}/part={i}"):  # files are taken by age
            os.utime(f"{src}/part={i}/{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema("u long, e string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    q = zs.expiring_dedupe(stream, ["u", "e"], "ts", "72 hours", "0 seconds", buckets=8).writeStream.format("memory") \
        .queryName("z2_shared").outputMode("append").trigger(availableNow=True).option("checkpointLocation", os.path.join(tmp_dir, "z2s")).start()
    q.awaitTermination()
    want = []
    for k in keys:
        last = None
        for t in sorted(t for *key, t in rows if tuple(key) == k):
            if last is None or t > last + 72 * hour:
                want.append((str(k), t))
                last = t
    got = spark.sql("SELECT u, e, unix_micros(ts) AS us FROM z2_shared").collect()
    assert sorted((str((r["u"], r["e"])), r["us"]) for r in got) == sorted(want)
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) <= 8


def test_table_stream_reads_a_file_and_a_folder_of_files(spark, tmp_dir):
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "id long, text string")
    folder, single = os.path.join(tmp_dir, "folder"), os.path.join(tmp_dir, "single")
    rows.repartition(3).write.parquet(os.path.join(folder, "t.parquet"))
    rows.coalesce(1).write.parquet(os.path.join(tmp_dir, "one"))
    os.makedirs(single)
    part = next(f for f in os.listdir(os.path.join(tmp_dir, "one")) if f.endswith(".parquet"))
    os.link(os.path.join(tmp_dir, "one", part), os.path.join(single, "t.parquet"))
    for at in (folder, single):
        out = spark.read.parquet(zs.run_available_now(zs.table_stream(spark, at, "t"), os.path.join(at, "out")))
        assert sorted(map(tuple, out.collect())) == [(i, f"text {i}") for i in range(20)]


def test_a_file_of_a_stream_is_parsed_by_many_tasks(spark, tmp_dir):
    src = os.path.join(tmp_dir, "one_file")
    spark.range(400).selectExpr("concat('http://h/', id) AS url", "concat('<p>', id, '</p>') AS html").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("url string, html string").parquet(src)
    tasks = zs.chunk_stream(stream).withColumn("task", F.spark_partition_id())
    out = spark.read.parquet(zs.run_available_now(tasks, os.path.join(tmp_dir, "z1_tasks")))
    assert out.count() == 400 and out.select("task").distinct().count() > 1
