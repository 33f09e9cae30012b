from quarry.operators.crawl import robots_allowed

BODY = "User-agent: special\nDisallow: /\n\nUser-agent: *\nDisallow: /private/\n"


def test_robots_rules(spark):
    urls = spark.createDataFrame([(u,) for u in [
        "http://a.gov.au/public/x", "http://a.gov.au/private/y", "http://b.gov.au/any",
        "http://c.gov.au/z", "http://d.gov.au/z"]], "url string")
    robots = spark.createDataFrame([("http://a.gov.au", 200, BODY), ("http://c.gov.au", 404, None),
                                    ("http://d.gov.au", 403, None)], "origin string, status int, body string")
    got = {r["url"]: r["robots_ok"] for r in robots_allowed(urls, robots, "url", "any-agent").collect()}
    assert got == {"http://a.gov.au/public/x": True, "http://a.gov.au/private/y": False,
                   "http://b.gov.au/any": False, "http://c.gov.au/z": True, "http://d.gov.au/z": False}
    special = {r["url"]: r["robots_ok"] for r in robots_allowed(urls, robots, "url", "special").collect()}
    assert special["http://a.gov.au/public/x"] is False
    allow = {r["url"]: r["robots_ok"] for r in
             robots_allowed(urls, robots, "url", "x", on_missing="allow").collect()}
    assert allow["http://b.gov.au/any"] is True
