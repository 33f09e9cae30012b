from pyspark.sql import functions as F

from quarry.functions import dates as dx


def test_extract_and_pick(spark):
    texts = [
        ("a", "Published 2023-05-01, covering 2024 and March 2025"),
        ("b", "as at 31/12/2019 and 2019/2/30"),
        ("c", "from 1989 to 2031, 12 June 2010"),
        ("d", "no dates"),
        ("e", "2023-05/01 only"),
    ]
    df = spark.createDataFrame(texts, "k string, t string")
    rows = {r["k"]: (r["d"], r["p"]) for r in df.select(
        "k", dx.extract_dates("t").alias("d"), dx.pick_date(dx.extract_dates("t"), 2026).alias("p")).collect()}
    assert rows["a"][0] == ["2023-05-01", "2023", "2024", "2025", "2025-03"]
    assert rows["a"][1] == "2025"                       # lexicographic max; YYYY-MM never kept
    assert rows["b"][0] == ["2019-12-31", "2019", "2019"]  # Feb 30 dropped
    assert rows["c"][0] == ["2010", "2010-06", "2010-06-12"] and rows["c"][1] == "2010-06-12"
    assert rows["d"] == ([], None)
    assert rows["e"][0] == ["2023"]                     # mixed separators do not parse
    assert df.select(dx.pick_date(F.array(F.lit("2027")), 2026)).first()[0] == "2027"
    assert df.select(dx.pick_date(F.array(F.lit("2028")), 2026)).first()[0] is None
