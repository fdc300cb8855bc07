from pyspark.sql import functions as F

from corpusloom.llm import warc

SCHEMA = "record_id long, url string, time long, status int, headers map<string,string>, payload string"


def records(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("key", "range", "stored", "outcome", "near", "carried")})


def test_canonical_urls(spark):
    urls = {
        "https://WWW.Example.com:443/a/?utm_source=x&b=2&a=1#top": "example.com/a?a=1&b=2", "http://example.com/": "example.com",
        "//example.com/index.html": "example.com", "HTTP://example.com/A?ref=1": "example.com/A", " about ": "about", "": "", None: None,
        "https://e.org:8080/x?": "e.org:8080/x",
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r[0]: r[1] for r in df.select("url", warc.canonical_url(F.col("url"))).collect()} == urls


def test_revisits(spark):
    rows = [
        (1, "http://e.com/a", 10, 200, {"ETag": '"1"', "Content-Length": "3", "Date": "d10"}, "one"),
        (2, "https://www.e.com/a/", 20, 200, {"ETag": '"2"', "Content-Length": "4", "Vary": "x"}, "twoo"),
        (3, "http://e.com/a#x", 15, 304, {"etag": 'W/"1"', "Date": "d15", "Content-Length": "0"}, None),
        (4, "http://e.com/a", 20, 304, {"etag": '"1"'}, None),  # the response of the same time is not earlier
        (5, "http://e.com/a", 21, 304, {"etag": '"1"'}, None),
        (6, "http://e.com/a", 9, 304, {"etag": '"1"'}, None),
        (7, "http://e.com/b", 1, 200, {"Last-Modified": "m"}, "b"),
        (8, "http://e.com/b", 2, 304, {"last-modified": "m"}, None),
        (9, "http://e.com/b", 900_000, 304, {"last-modified": "n"}, None),
        (10, "http://e.com/b", 3, 304, None, None),
        (11, None, 3, 304, {}, None), (None, "http://e.com/b", 3, 304, {}, None), (12, "http://e.com/b", None, 304, {}, None),
        (13, "http://e.com/b", 4, 404, {}, "gone"), (14, "http://e.com/b", 4, None, {}, None),
        (8, "http://e.com/b", 2, 304, {"last-modified": "m"}, None),
    ]
    got = {r.record_id: r for r in warc.resolve_revisits(records(spark, rows)).collect()}
    assert {i: (r.response_id, r.outcome, r.payload) for i, r in got.items()} == {
        3: (1, "resolved", "one"), 4: (1, "resolved", "one"), 5: (2, "changed", None), 6: (None, "no earlier response", None),
        8: (7, "resolved", "b"), 9: (7, "changed", None), 10: (7, "no validator", None),
    }
    assert got[3].headers == {"etag": 'W/"1"', "date": "d15", "content-length": "3"} and got[5].headers is None
    assert got[3].canonical_url == "e.com/a"
    assert warc.resolve_revisits(records(spark, rows).filter("false")).count() == 0


def test_one_hot_url_agrees_with_a_plain_search(spark):
    rows = [(i, "http://hot.com/", i * 37 % 5003, 200 if i % 3 == 0 else 304, {"etag": f'"{i % 2}"'}, f"p{i}") for i in range(1500)]
    full = sorted((t, i) for i, _, t, s, _, _ in rows if s == 200)
    got = {r.record_id: r.response_id for r in warc.resolve_revisits(records(spark, rows)).collect()}
    assert got == {i: max(((t, j) for t, j in full if t < time), default=(None, None))[1] for i, _, time, s, _, _ in rows if s == 304}


def test_later_header_names_win(spark):
    df = spark.sql("SELECT map('A', '1', 'b', '2', 'a', '3') AS h UNION ALL SELECT CAST(NULL AS map<string,string>)")
    assert [r[0] for r in df.select(warc.lower_headers(F.col("h"))).collect()] == [{"b": "2", "a": "3"}, {}]
