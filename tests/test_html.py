from pyspark.sql import functions as F

from quarry.functions.html import page_nodes

BASE = "http://site.gov.au/dir/page"


def _text(rows, row):
    return "|".join(r["text"] for r in rows[row["i"] + 1:row["end"]] if r["text"] is not None and not r["hidden"])


def test_tree_rules():
    rows = page_nodes("<p>a<p>b</p>c</p><br></br><b>x</i>y</b>", BASE)
    ps = [r for r in rows if r["tag"] == "p"]
    assert len(ps) == 2 and ps[1]["up"] == ps[0]["i"]          # no implied end tag: nested
    assert _text(rows, ps[0]) == "a|b|c"
    b = next(r for r in rows if r["tag"] == "b")
    assert _text(rows, b).replace("|", "") == "xy"               # stray </i> ignored
    rows = page_nodes("<div><script>var t='</p>';</script><p>keep</p>", BASE)
    assert [r["text"] for r in rows if r["text"] and not r["hidden"]] == ["keep"]  # script text is not text
    assert page_nodes(None, None) == []


def _fields(spark, html):
    from quarry.operators.pages import extract_pages

    df = spark.createDataFrame([(1, BASE, html)], "page_id long, url string, html string")
    return extract_pages(df).first()


def test_description_priority_and_fallback(spark):
    html = ('<html><head><meta name="description" content="  ">'
            '<meta property="og:description" content="OG"></head>'
            '<body><p>First &amp; <b>para</b></p><p>second</p></body></html>')
    f = _fields(spark, html)
    assert f["description"] == "First & para"               # blank meta found first: og ignored
    assert f["description_chunk"] == "First & para"
    html2 = '<meta property="og:description" content="OG &amp;amp; x"><p>p</p>'
    f2 = _fields(spark, html2)
    assert f2["description"] == "OG & x"                    # unescaped twice, as the reference
    assert f2["description_chunk"] == "p"                   # the chunk variant reads only name=description
    long_p = "<p>" + "w " * 400 + "</p>"
    assert len(_fields(spark, long_p)["description"]) == 500
    assert _fields(spark, "<div>no paragraph</div>")["description"] == ""


def _tags(spark, html):
    from quarry.operators.pages import extract_pages

    df = spark.createDataFrame([(1, BASE, html)], "page_id long, url string, html string")
    return extract_pages(df).first()["tags"]


def test_tags_priority_caps_and_case(spark):
    kws = ",".join(f"kw{i}" for i in range(12))
    html = (f'<meta name="keywords" content="{kws}">'
            '<meta name="dc.subject" content="KW1"><meta name="dcterms.subject" content="Sub">'
            '<meta property="article:tag" content="art">'
            '<script type="application/ld+json">{"keywords": "ld1, ld2"}</script>')
    assert _tags(spark, html) == ["kw0", "kw1", "kw2", "kw3", "kw4", "Sub"]  # 5 keywords, KW1 repeats, 6 -> stop
    html = ('<script type="application/ld+json">[{"keywords": ["a1", "b2", "B2"]}, 3]</script>'
            '<script type="application/ld+json">{bad json</script><meta name="keywords" content="x">')
    assert _tags(spark, html) == ["a1", "b2"]      # 'x' too short; case-insensitive distinct
    many = "".join(f'<meta property="article:tag" content="t{i}">' for i in range(12))
    assert _tags(spark, '<meta name="keywords" content="a1,b2">' + many) == \
        ["a1", "b2", "t0", "t1", "t2", "t3", "t4", "t5"]          # article tags fill up to 8


def test_links_and_visible_text(spark):
    html = ('<html><head><title>T &amp; t</title></head><body><nav><a href="/n">Nav</a></nav>'
            '<ul><li><p>item <a href="../rel#f">Rel</a></p></li></ul>'
            '<a href="mailto:x@y">m</a><a href="">blank</a><a href="javascript:void(0)">j</a>'
            '<h1>Head</h1><footer>foot</footer></body></html>')
    f = _fields(spark, html)
    assert f["title"] == "T & t"
    assert [l["url"] for l in f["links"]] == ["http://site.gov.au/n", "http://site.gov.au/rel"]
    assert [l["anchor"] for l in f["links"]] == ["Nav", "Rel"]
    assert f["body_hrefs"] == ["http://site.gov.au/rel#f"]      # nav removed first
    assert f["visible_text"] == "Head\nitem Rel\nitem Rel"     # h1 first, then p, then li (repeat)


def test_date_texts(spark):
    html = ('<title>Report 2021</title><meta name="dcterms.modified" content="2022-03-04">'
            '<time datetime="2019-01-02">2 January 2019</time><div>Last updated 5/6/2020</div>')
    f = _fields(spark, html)
    assert "2022-03-04" in f["date_texts"] and "2019-01-02" in f["date_texts"]
    assert "Last updated 5/6/2020" in f["date_texts"]


def test_pages_are_parsed_in_bounded_pieces(spark, monkeypatch):
    """Every page keeps its place when a batch is parsed piece by piece; a piece is small or one page."""
    import pandas as pd

    from quarry.functions import html as hx

    pages = pd.Series(["<p>a</p>" * n if n % 5 else None for n in range(1, 300)])
    sizes = [0 if p is None else len(p) for p in pages]
    monkeypatch.setattr(hx, "PARSED", 4000)
    pieces = list(hx._pieces(pages))
    assert [lo for lo, _ in pieces] == [0] + [hi for _, hi in pieces[:-1]] and pieces[-1][1] == len(pages)
    assert all(hi == lo + 1 or sum(sizes[lo:hi]) <= 4000 for lo, hi in pieces) and len(pieces) > 50
    monkeypatch.undo()
    df = spark.range(3000).selectExpr("id", "concat('<p>', repeat(concat('t', id, ' '), 40), '</p>') AS html", "'http://h/' AS url")
    got = df.coalesce(1).select("id", F.element_at(hx.nodes("html", "url"), 2)["text"].alias("t")).collect()
    assert len(got) == 3000 and all(r.t.startswith(f"t{r.id} ") for r in got)


def test_a_batch_of_pages_stays_in_arrow(spark):
    """Parsing a batch makes Python strings of a piece only, whatever the batch holds."""
    import tracemalloc

    import pyarrow as pa

    from quarry.functions import html as hx

    pages = pa.array([f"<p>{'t' * 20_000}{i}</p>" for i in range(1000)] + [None])  # 20 MB
    urls = pa.array(["http://h/"] * len(pages))
    tracemalloc.start()
    rows = [n for part in hx._nodes.func(iter([(pages, urls)])) for n in part[-1:].to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows[-1] == [] and peak < 4 << 20
    got = list(hx._nodes.func(iter([(pa.array(['<a href="/x" b>y</a>', None]), pa.array(["http://h/p", None]))])))
    assert [[dict(n["attrs"]) if n["attrs"] else n["text"] for n in p] for a in got for p in a.to_pylist()] == \
        [[{"href": "/x", "b": ""}, "y"], []]
