"""Patterns on Unicode blanks and digits, url escapes, scratch folders, CSV blanks, empty lists."""

import re
from urllib.parse import parse_qsl, urlencode

import pytest
from pyspark.sql import functions as F

from quarry.functions import catalog as cf
from quarry.functions import dates as dx
from quarry.functions import trust as tr
from quarry.functions import urls as ux
from quarry.plans import sqltext as S


def test_claims_with_unicode_blanks(spark):
    texts = ["up 5 million people", "12 % x", "about 3 billion", "7 percent", "٥ million", "5 millions", "x5 million"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [(list(r.c), r.m) for r in df.select(tr.numeric_claims("t").alias("c"), tr.mask_claims("t").alias("m")).collect()]
    claim = re.compile(tr.CLAIM_PATTERN.replace("(?iuU)", "(?i)"))
    mask = re.compile(tr.MASK_PATTERN.replace("(?iuU)", "(?i)"))
    assert got == [(claim.findall(t), mask.sub(tr.MASK_TEXT, t)) for t in texts]
    assert got[0] == (["5 million"], "up [data available] people")


def test_month_dates_with_unicode_blanks(spark):
    texts = ["3 March 2021", "April 2020", "on 05/06/2019", "٢٠٢١"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(dx.extract_dates("t").alias("d")).collect()
    assert rows[0].d == ["2021", "2021-03", "2021-03-03"] and rows[1].d == ["2020", "2020-04"] and "2019-06-05" in rows[2].d


def test_frequency_with_unicode_blank(spark):
    df = spark.createDataFrame([([("x", "FREQUENCY = Q", None)],)], "a array<struct<type:string,title:string,text:string>>")
    assert df.select(cf.infer_freq("a").alias("f")).first().f == "quarterly"


def test_oracle_patterns_agree_with_the_code(spark):
    """The oracle's own RE2 patterns find the same claims on blanks of every kind."""
    import duckdb
    texts = [f"a 5{b}million b" for b in "\t\n\x0b\f\r \x85\xa0      　"]
    con = duckdb.connect()
    exp = [con.execute(f"SELECT regexp_extract_all(?, '{S.CLAIM}', 0)", [t]).fetchall()[0][0] for t in texts]
    got = [list(r.c) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(tr.numeric_claims("t").alias("c")).collect()]
    assert got == exp and all(exp)


def test_bad_escapes_in_queries(spark):
    urls = ["http://h/p?x=a%20b%zz", "http://h/p?x=%", "http://h/p?x=100%&y=%41", "http://h/p?a=b+c&d"]
    got = [r.c for r in spark.createDataFrame([(u,) for u in urls], "u string").select(ux.canonical("u").alias("c")).collect()]
    assert got == ["http://h/p?" + urlencode(parse_qsl(u.split("?")[1], keep_blank_values=True)) for u in urls]
    assert got[0] == "http://h/p?x=a+b%25zz"


def test_no_machine_local_checkpoint_folder_on_a_cluster(monkeypatch):
    from quarry import session

    class Context:
        master = "spark://host:7077"
        def getConf(self): return {}
        def getCheckpointDir(self): return None

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_scratch_tables_are_deleted(spark):
    from quarry import session
    from quarry.sources.catalog_csv import path_exists

    kept = list(session._SCRATCH)
    path = session.scratch_path(spark)
    spark.range(3).write.parquet(path)
    session._SCRATCH[:] = [(spark, path)]
    session._drop_scratch()
    session._SCRATCH[:] = kept
    assert not path_exists(spark, path)


def test_csv_keeps_blanks(spark, tmp_dir):
    from quarry.sources.sinks import CHUNK_COLUMNS, write_chunks_csv

    row = spark.range(1).select(*[F.lit(" ends with space ").alias(c) for c in CHUNK_COLUMNS])
    write_chunks_csv(row, f"{tmp_dir}/c")
    back = spark.read.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(f"{tmp_dir}/c")
    assert back.first().title == " ends with space "
