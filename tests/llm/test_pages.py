import html
import random
import re

from pyspark.sql import functions as F

from corpusloom.llm import pages

PAGE = """<!DOCTYPE html><html><head><title>no</title><script>var a = "</p>";</script></head><body class="home ad-free">
<header><h1>Site</h1></header><div id="menu"><a>Home</a></div><div class="cookie-notice">We use cookies</div>
<main><article><header><h1>T &amp; x</h1></header><p>One<br>two &eacute;&#8217;s <b>bold</b>text<p>Three
 words <form><input>Sign</form><aside>side</aside><section class="comments"><p>nice!</p></section>
<ul><li>a<li>b</ul><table><tr><td>c1<td>c2</table><!-- note --></article></main><div class='sidebar'>S</div><footer>f</footer></body>"""


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_lines_are_a_longest_subsequence():
    draw = random.Random(2)
    for _ in range(500):
        a, b = ([draw.randint(0, 6) for _ in range(draw.randint(0, 14))] for _ in range(2))
        mask = pages.common_lines(a, b)
        kept, rest = [x for x, k in zip(a, mask) if k], iter(b)
        assert all(x in rest for x in kept) and len(kept) == longest(a, b)


def test_places_and_references():
    assert pages.main_text(PAGE, []) == "T & x\n\nOne two é’s boldtext\n\nThree words\n\na\n\nb\n\nc1\n\nc2"
    for empty in (None, "", "<div>", "<!-- x", "<script>x", "<p", "   "):
        assert pages.main_text(empty, []) == ""
    assert pages.main_text("plain &lt;text&gt;", []) == "plain <text>"
    assert pages.main_text("<p>" * 50_000 + "x" * 100_000, []) == "x" * 100_000


def test_drawings_close_themselves_and_nest():
    def text(body):
        return pages.main_text(f"<article><p>a</p>{body}<p>b</p></article>", [])

    for drawing in (
        '<svg viewBox="0 0 1 1"/>', "<math/>", "<svg><path d='M0 0'/><text>x</text></svg>", "<svg><svg>x</svg>y</svg>", "<math><mi>x</mi></math>",
        "<svg><title>t</title><style>p > a</style><foreignObject><div>x</div></foreignObject></svg>", "<svg><g>never closed",
    ):
        assert text(drawing) == "a\n\nb", drawing
    assert text("<p>c <svg/>d <svg>x</svg>e</p>") == "a\n\nc d e\n\nb"


def test_names_are_read_word_by_word():
    def text(body):
        return pages.main_text(f"<body class='has-sidebar'>{body}</body>", [])

    assert text("<div class='layout sidebar-right'><article><div class='entry-header'><h1>T</h1></div><p>a</p></article></div>") == "T\n\na"
    assert text("<p>a <span class='ad-label'>Ad</span>b <button>Share</button>c</p><div class='shares'>d</div>") == "a b c\n\nd"
    assert text("<section id='comments'><article class='comment'><p>nice</p></article></section><main><p>x</p></main>") == "x"
    assert text("<div class='left-sidebar'>s</div><div class=\"no-banner adapt\">t</div><div id=cookie_notice>u</div>") == "t"
    assert text("<div hidden>a</div><div style='display: none'>b</div><div data-hidden=no>c</div>") == "c"


def site(number, story, marked=False):
    body = f"<div><h1>Story {number}</h1><p>{story}</p></div>"
    body = f"<article>{body}</article>" if marked else body
    return f"<body><div>Our site</div><div>Top stories</div>{body}<div>All rights reserved</div></body>"


def run(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("clash") for c in ("key", "host", "path", "lines", "shared", "text", "id", "place", "chunk")}
    )
    return pages.extract(df)


def test_lines_shared_with_the_nearest_page_go(spark):
    rows = [(i, f"https://e.com/s/{i}", site(i, f"words of {i}")) for i in range(6)]
    rows += [(9, "https://e.com/s/5", site(5, "words of 5"))]  # a copy says nothing about the site
    rows += [(20 + i, f"https://m.com/s/{i}", site(i, "the common passage", marked=True)) for i in range(3)]
    rows += [(30, "https://alone.com/", site(30, "all of it"))]
    got = {r.page_id: r.text for r in run(spark, rows).collect()}
    assert all(got[i] == f"Story {i}\n\nwords of {i}" for i in range(6)) and got[9] == got[5]
    assert all(got[20 + i] == f"Story {i}\n\nthe common passage" for i in range(3))
    assert got[30] == "Our site\n\nTop stories\n\nStory 30\n\nall of it\n\nAll rights reserved"


def test_odd_rows(spark):
    rows = [
        (1, "https://e.com/", "<p>a"), (1, "https://e.com/", "<p>a"), (None, "https://e.com/x", "<p>b</p>"), (3, None, "<p>c"),
        (4, "no url", None), (5, "", ""), (6, "https://e.com/y", None),
    ]
    got = run(spark, rows)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted((str(r.page_id), str(r.url), r.text) for r in got.collect()) == sorted(
        (str(i), str(u), {1: "a", None: "b", 3: "c"}.get(i, "")) for i, u, _ in rows
    )
    assert run(spark, rows).filter("false").count() == 0
    assert pages.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_chunks_change_nothing(spark, monkeypatch):
    rows = [(i, f"https://e{i % 2}.com/{i:04d}", site(i, f"words of {i}")) for i in range(300)]
    want = sorted(map(tuple, run(spark, rows).collect()))
    monkeypatch.setattr(pages, "CHUNK_ROWS", 7)
    assert sorted(map(tuple, run(spark, rows).collect())) == want


def test_menus_are_no_copies_and_teasers_no_articles(spark):
    menu = "".join(f"<div>Link {i}</div>" for i in range(60))
    rows = [(i, f"https://e.com/{i}", menu + "".join(f"<p>Line {j} of story {i}, with words of its own and a few more.</p>" for j in range(4))) for i in range(2)]
    got = {r.page_id: r.text for r in run(spark, rows).collect()}
    assert all(got[i].startswith(f"Line 0 of story {i}") and got[i].count("\n\n") == 3 for i in range(2))
    teaser = "<div class='related'><article><p>teaser</p></article></div>"
    assert pages.main_text(f"<article><p>main</p></article>{teaser}", []) == "main" and pages.main_text(teaser, []) == "teaser"
    assert pages.main_text("<article><p>a</p></article><article><p>b</p></article>", []) == "a\n\nb"


def test_long_runs_of_copies_meet_the_page_that_differs(spark, monkeypatch):
    story = " ".join(f"word{i}" for i in range(60))

    def copy(i):  # near copies: a counter differs
        return f"<div>Our site</div><p>{story}</p><p>{i}</p><div>All rights reserved</div>"

    other = "<div>Our site</div><p>" + story[::-1] + "</p><div>All rights reserved</div>"
    rows = [(i, f"https://a.com/{i:03d}", copy(i)) for i in range(1, 40)] + [(0, "https://a.com/000", other)]
    rows += [(100 + i, f"https://b.com/{i:03d}", copy(i)) for i in range(40)] + [(140, "https://b.com/999", other)]
    rows += [(200 + i, f"https://c.com/{i:03d}", copy(7)) for i in range(40)]  # only copies: nothing to learn
    for size in (256, 7, 3):
        monkeypatch.setattr(pages, "CHUNK_ROWS", size)
        got = {r.page_id: r.text for r in run(spark, rows).collect()}
        want = {i: f"{story}\n\n{i % 100}" for i in [*range(1, 40), *range(100, 140)]}
        assert {i: got[i] for i in want} == want
        assert got[0] == got[140] == story[::-1]
        assert all(got[i].startswith("Our site") for i in range(200, 240))


def simple_article(page):
    body = re.search(r"<article>(.*?)(?:</article>|$)", page, re.DOTALL).group(1)
    blocks = re.split(r"</?(?:p|h1|footer)[^>]*>", body)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_query_gives_the_articles(spark, sf):
    from corpusloom.llm.queries import all_queries

    source = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = all_queries()["op1_html_extraction"](spark, sf).collect()
    assert len(rows) == len(source)
    for r in rows:
        assert r.text == simple_article(source[r.page_id].html) and r.url == source[r.page_id].url and r.n_chars == len(r.text)
