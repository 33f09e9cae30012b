from collections import deque

import pytest
from pyspark.sql import functions as F

from quarry.operators import crawl as cr


def _graph(n=40):
    pages = {f"http://s{i % 3}.gov.au/p{i}": i for i in range(n)}
    urls = list(pages)
    links = {}
    for u, i in pages.items():
        out = [urls[(i * 7 + 1) % n], urls[(i * 3 + 2) % n], f"http://s{i % 3}.gov.au/f{i}.csv",
               f"http://other.org/p{i}", urls[(i * 5 + 3) % n]]
        if i % 4 == 0:
            out.append(f"http://s{i % 3}.gov.au/f{i}b.xlsx")
        links[u] = out
    return pages, links


def _fifo(seeds, pages, links, max_pages, max_files, blocked=frozenset()):
    q, enq, visited, order, files = deque(), set(), set(), [], []
    for s in seeds:
        if s not in enq:
            q.append(s)
            enq.add(s)
    in_scope = lambda u: u.split("/")[2].endswith(".gov.au")
    is_data = lambda u: u.endswith((".csv", ".xlsx"))
    while q and len(order) < max_pages and len(files) < max_files:
        u = q.popleft()
        if u in visited or not in_scope(u) or u in blocked or u not in pages:
            continue
        visited.add(u)
        order.append(u)
        for l in links[u]:
            if not is_data(l) and in_scope(l) and l not in visited and l not in enq:
                enq.add(l)
                q.append(l)
        for l in links[u]:
            if is_data(l):
                files.append((l, u))
                if len(files) >= max_files:
                    break
    return order, files


def _inputs(spark, pages, links):
    docs = spark.createDataFrame([(u, "text/html", f"title {i}", "", [], []) for u, i in pages.items()],
                                 "url string, content_type string, title string, description string, "
                                 "tags array<string>, date_texts array<string>")
    edges = spark.createDataFrame([(u, j, l, f"a{j}") for u, ls in links.items() for j, l in enumerate(ls)],
                                  "src string, pos long, dst string, anchor string")
    fetches = spark.createDataFrame([(l, "text/csv", "10") for ls in links.values() for l in ls
                                     if l.endswith((".csv", ".xlsx"))],
                                    "link string, content_type string, content_length string").distinct()
    return docs, edges, fetches


@pytest.mark.parametrize("max_pages,max_files", [(500, 500), (7, 500), (500, 9), (12, 12)])
def test_bfs_matches_fifo_queue(spark, max_pages, max_files):
    pages, links = _graph()
    seeds = ["http://s0.gov.au/p0", "http://s1.gov.au/p1#x"]
    order, files = _fifo([s.split("#")[0] for s in seeds], pages, links, max_pages, max_files)
    docs, edges, fetches = _inputs(spark, pages, links)
    got_pages, got_hits = cr.crawl_files(cr.seeds_frame(spark, seeds), docs, edges, fetches, None,
                                         max_pages=max_pages, max_files=max_files)
    got_order = [r["url"] for r in got_pages.orderBy("depth", "seq").collect()]
    assert got_order == order
    hits = [(r["file_url"], r["page_url"]) for r in got_hits.orderBy("page_depth", "page_seq", "pos").collect()]
    assert hits == files


def test_depth_is_minimal(spark):
    pages, links = _graph()
    docs, edges, fetches = _inputs(spark, pages, links)
    got, _ = cr.crawl_files(cr.seeds_frame(spark, "http://s0.gov.au/p0"), docs, edges, fetches, None)
    depth = {r["url"]: r["depth"] for r in got.collect()}
    # brute-force BFS distances over followable edges
    dist, q = {"http://s0.gov.au/p0": 0}, deque(["http://s0.gov.au/p0"])
    while q:
        u = q.popleft()
        for l in links.get(u, []):
            if l in pages and l not in dist:
                dist[l] = dist[u] + 1
                q.append(l)
    assert depth == {u: d for u, d in dist.items()}


def test_chunk_crawl_depth_and_cap(spark):
    pages, links = _graph(12)
    docs = spark.createDataFrame([(u, 200, "text/html", u, f"t{i}", "", f"text of page {i}")
                                  for u, i in pages.items()],
                                 "url string, status int, content_type string, final_url string, "
                                 "title_text string, description_chunk string, visible_text string")
    ls = spark.createDataFrame([(u, l) for u, v in links.items() for l in v], "src string, dst string")
    visited, rows = cr.crawl_chunks(cr.seeds_frame(spark, ["http://s0.gov.au/p0"], "canonical"), docs, ls,
                                    max_pages=5, max_depth=1)
    v = visited.collect()
    assert max(r["depth"] for r in v) <= 1
    html_rows = rows.where(F.col("source_type") == "html").select("url").distinct().count()
    assert html_rows <= 5
    assert rows.where(F.col("chunk_text") == "text of page 0").count() == 1


def test_walk_is_uncapped_by_default(spark):
    """A chain longer than any former cap: every page is reached."""
    n = 12
    pages = [f"http://s0.gov.au/p{i}" for i in range(n)]
    fan = [(pages[0], i, f"http://s0.gov.au/q{i}") for i in range(900)]
    docs = spark.createDataFrame([(u, "text/html", u, "", [], []) for u in pages + [d for _, _, d in fan]],
                                 "url string, content_type string, title string, description string, tags array<string>, date_texts array<string>")
    edges = spark.createDataFrame([(a, 1000, b, "x") for a, b in zip(pages, pages[1:])] + [(s, p, d, "y") for s, p, d in fan],
                                  "src string, pos long, dst string, anchor string")
    none = spark.createDataFrame([], "link string, content_type string, content_length string")
    got, _ = cr.crawl_files(cr.seeds_frame(spark, [pages[0]]), docs, edges, none, None)
    rows = {r.url: r.depth for r in got.select("url", "depth").collect()}
    assert len(rows) == n + 900 and rows[pages[-1]] == n - 1


def test_robots_rules_equal_the_standard_parser(spark):
    from urllib.robotparser import RobotFileParser

    bodies = ["User-agent: *\nDisallow: /es/\nAllow: /", "User-agent: *\nAllow: /a/b\nDisallow: /a\nDisallow: /q?x=1",
              "User-agent: quarry-files\nDisallow: /only\n\nUser-agent: *\nDisallow: /", "User-agent: other\nDisallow: /", "",
              "User-agent: *\nDisallow:", "User-agent: *\nDisallow: /caf%C3%A9\nDisallow: /a b\nDisallow: /~u"]
    paths = ["", "/", "/es/x", "/a", "/a/b/c", "/q?x=1&y", "/q?x=2", "/only/1", "/caf\u00e9/1", "/caf%c3%a9", "/a%20b", "/%7Eu/x", "/50%", "/a+b;p#f"]
    robots = spark.createDataFrame([(f"http://h{i}.gov.au", 200, b) for i, b in enumerate(bodies)]
                                   + [("http://e1.gov.au", 403, ""), ("http://e2.gov.au", 404, ""), ("http://e3.gov.au", 500, "")],
                                   "origin string, status int, body string")
    urls = [f"http://h{i}.gov.au{p}" for i in range(len(bodies)) for p in paths]
    more = ["http://e1.gov.au/x", "http://e2.gov.au/x", "http://e3.gov.au/x", "http://none.gov.au/x"]
    df = spark.createDataFrame([(u,) for u in urls + more], "url string")
    got = {r.url: r.robots_ok for r in cr.robots_allowed(df, robots, "url", "quarry-files/1.0").collect()}
    for i, b in enumerate(bodies):
        rp = RobotFileParser()
        rp.parse(b.splitlines())
        for p in paths:
            u = f"http://h{i}.gov.au{p}"
            assert got[u] == rp.can_fetch("quarry-files/1.0", u), (b, u)
    assert [got[u] for u in more] == [False, True, False, False]


def test_chunk_crawl_follows_body_links_and_keeps_every_chunk(spark, tmp_dir):
    """Pages that only links in a page's body lead to; ids beyond the page count have no derived links to them."""
    from quarry.operators import pages as pg
    from quarry.plans import registry

    at = "http://ab.example.org"
    body = lambda links, text="short": f"<html><title>t</title><body><nav><a href='/nav'>n</a></nav><p>{text}</p>" + "".join(
        f"<a href='{x}'>x</a>" for x in links) + "</body></html>"
    long = " ".join(f"word{i}." for i in range(600))
    rows = [(0, at + "/start", body(["/deep#part", "/es/closed", "/absent", "http://other.test/x"])),
            (700, at + "/deep", body([at + "/deeper"], long)), (707, at + "/deeper", body([], long[:2000])),
            (714, at + "/nav", body([])), (721, at + "/es/closed", body([]))]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_dir}/pages.parquet")
    seen = {(r.url, r.depth) for r in registry.m3_crawl_chunks(spark, tmp_dir).where("source_type = 'html'").collect()}
    assert seen == {(at + "/start", 0), (at + "/deep", 1), (at + "/deeper", 2)}
    columns = ("url", "title", "chunk_index", "chunk_total", "chunk_text")
    fields = pg.extract_pages(spark.read.parquet(f"{tmp_dir}/pages.parquet"))
    expected = {tuple(r) for r in pg.page_chunks(fields).select(*columns).collect() if (r.url in {u for u, _ in seen})}
    got = [tuple(r) for r in registry.m3_chunk_rows(spark, tmp_dir).where("source_type = 'html'").select(*columns).collect()]
    assert len(got) == len(set(got)) and set(got) == expected and len(got) >= 5


def test_long_chain_keeps_short_numbers_and_reads_its_own_buckets(spark, monkeypatch):
    """A chain of pages, each with a link back: order numbers stay 8 bytes, small levels look at their own buckets."""
    from quarry.operators import crawl as cr

    n = 12
    url = lambda i: f"http://a.gov.au/p{i}"
    docs = spark.createDataFrame([(url(i), "text/html", "t", "d", [], []) for i in range(n)],
                                 "url string, content_type string, title string, description string, tags array<string>, date_texts array<string>")
    edges = spark.createDataFrame([(url(i), p, url(j), "x") for i in range(n) for p, j in ((0, max(i - 1, 0)), (1, i + 1))],
                                  "src string, pos long, dst string, anchor string")
    fetches = spark.createDataFrame([], "link string, content_type string, content_length string")
    asked = []
    real = cr._prune
    monkeypatch.setattr(cr, "_prune", lambda t, present: asked.append(present) or real(t, present))
    seeds = cr.seeds_frame(spark, [url(0)])
    pages, _ = cr.crawl_files(seeds, docs, edges, fetches)
    assert [(r.url, r.depth) for r in pages.orderBy("depth").collect()] == [(url(i), i) for i in range(n)]
    assert pages.schema["seq"].dataType.typeName() == "long"
    assert all(a is not None and len(a) <= 2 for a in asked)
    capped, _ = cr.crawl_files(seeds, docs, edges, fetches, max_pages=5)
    assert sorted(r.depth for r in capped.collect()) == list(range(5))


def test_seed_texts_of_a_table_equal_the_list_form(spark):
    from quarry.operators import crawl as cr

    text = " http://b/x#f, ,http://a/y,http://b/x ,,http://c "
    table = spark.createDataFrame([(1, text), (2, "http://a/y,http://d")], "id long, t string")
    got = [r.url for r in cr.seeds_table(table, "t", "id").orderBy("seq").collect()]
    assert got == [r.url for r in cr.seeds_frame(spark, text + ",http://a/y,http://d").orderBy("seq").collect()]
    assert got == ["http://b/x", "http://a/y", "http://c", "http://d"]
