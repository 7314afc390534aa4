"""URL templates and HTML extraction on small tables with known answers."""

import random
import time

import pytest
from pyspark.sql import functions as F
from waybill.llm import html_extract, oracle, queries, url_templates

RULES = queries.URL_RULES


def slow_rule(host, path):
    fits = [
        r for r in RULES
        for name, start in [r.split("/", 1)]
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start)
    ]
    return max(fits, key=len, default=None)


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.Net/en/1?x#y", "http://a.example.net/EN/1",
    "https://example.net", "https://example.net?q=/en/", "x://www.example.com/de/#top",
    "http://notexample.com/de/a", "http://b.org/fr/x://y/z", "http://org/fr/", "http://c.com//de/",
    "http://c.com/" + "a/" * 5000, "http://ÄÖ.COM/\n/x",
]


def test_rules_and_parts(spark):
    df = spark.createDataFrame([(i, u, 1, 2) for i, u in enumerate(URLS)], "page_id int, url string, host int, f_host int")
    got = {r.page_id: r for r in url_templates.judge_urls(df, RULES).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        rule = slow_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == (RULES[rule] if rule else "allow")
    assert url_templates.judge_urls(df.limit(0), RULES).count() == 0


def test_bad_branches_are_rejected(spark):
    """A host with a good and a bad branch, variable names below both."""
    random.seed(1)
    rows = []
    for i in range(400):
        bad = i % 4 == 0
        name = "".join(random.choices("bcdfghjkl", k=8))
        url = f"http://h.com/{'promo' if bad else 'news'}/{name}/{i}.html"
        label = None if i % 3 == 0 else (not bad) if i % 40 else bad
        rows.append((i, url, label))
    rows += [(1000 + i, f"http://tiny.com/p/{i}", False) for i in range(3)]
    df = spark.createDataFrame(rows, "page_id int, url string, good boolean")
    got = url_templates.judge_urls(df, {}, good=F.col("good")).toPandas()
    assert set(got[got.path.str.startswith("/promo")].verdict) == {"block"}
    assert set(got[got.path.str.startswith("/news")].verdict) == {"allow"}
    templates = set(got[got.host == "h.com"].template)
    assert templates == {"h.com/promo", "h.com/news"}  # what lies below does not differ, so it merged
    # three bad labels are too few against the smoothing
    assert set(got[got.host == "tiny.com"].verdict) == {"allow"}


def test_variable_segments_become_wildcards(spark):
    rows = [("h", [f"u{chr(97 + i // 26)}{chr(97 + i % 26)}", "page"], 1, 0, 0) for i in range(200)]
    rows += [("h", ["fixed", "x"], 500, 0, 0), ("g", ["a"], 3, 0, 0)]
    df = spark.createDataFrame(rows, "host string, shapes array<string>, n bigint, labelled bigint, good bigint")
    got = {(r.host, tuple(r.template)) for r in url_templates.templates(df).collect()}
    assert got == {("h", ("*", "page")), ("h", ("*", "x")), ("g", ("a",))}


BODY = "<p>First paragraph of the article, long enough.<p>Second &amp; last one here."
NOISE = (
    "<nav><a href=/>Menu</a></nav><header>Site name</header>",
    "<div class='sidebar-2'><p>Popular posts of the whole week are listed here.</p></div>"
    "<div id=cookieNotice>We use cookies on this site, please accept them all.</div>"
    "<section class=comments><article class='comment c1'><p>A reader said something long about it."
    "</article></section><form>Mail <input></form><footer>&copy; all</footer>",
)


def page(open_tag="<div class='post-17'>", close="</div>", body=BODY):
    return (
        f"<!doctype html><html><head><title>T</title><script>var a='</p>'</script><style>p{{}}</style>"
        f"</head><body>{NOISE[0]}{open_tag}{body}{close}{NOISE[1]}</body></html>"
    )


WANT = "First paragraph of the article, long enough.\n\nSecond & last one here."


@pytest.mark.parametrize(
    "tag, end",
    [
        ("<div class='post-17'>", "</div>"), ("<article>", "</article>"), ("<main><section>", "</main>"),
        ("<table><tr><td class=body>", "</table>"), ("<DIV CLASS=Post>", "</DIV>"),
    ],
)
def test_article_without_the_rest(tag, end):
    assert html_extract.Page(page(tag, end)).article([])[0] == WANT


def test_titles_belong_to_the_article():
    inner = f"<h1>Title</h1><div class=entry>{BODY}</div>"
    for tag, end in (("<div class=post>", "</div>"), ("<article>", "</article>")):
        assert html_extract.Page(page(tag, end, inner)).article([])[0] == "Title\n\n" + WANT
    parts = "<h1>T</h1><section><p>One section with some words.</section><section><p>Two of them here.</section>"
    text = html_extract.Page(page("<main><article>", "</main>", parts)).article([])[0]
    assert text == "T\n\nOne section with some words.\n\nTwo of them here."


@pytest.mark.parametrize(
    "box",
    ["<div class=userComments>", "<div id=sitefooter>", "<aside>", "<div role=complementary>",
     "<section class='widget ad-slot'>", "<div class=cookie-notice>", "<div hidden>", "<form>",
     "<div class='related posts'>", "<ul class=pagination>", "<div aria-hidden=true>"],
)
def test_boxes_inside_the_article_go(box):
    end = "</" + box[1:].split(" ")[0].split(">")[0] + ">"
    inner = BODY + box + "<p>Some words that do not belong to the article at all.</p>" + end
    assert html_extract.Page(page("<article>", "</article>", inner)).article([])[0] == WANT


def test_blocks_and_references():
    text = html_extract.Page(
        "<article><h1>A\n  title</h1>\t<p>x&nbsp;<b>y</b>&#8364;<br>z<!-- <p>no --><ul><li>1<li>2</ul>"
        "<pre> a\n b</pre>1 &lt; 2 &am<aside>no</aside></article>"
    ).article([])[0]
    assert text == "A title\n\nx y€ z\n\n1\n\n2\n\na b\n\n1 < 2 &am"


def test_consensus_helps_short_pages(spark):
    """A page whose own best container is wrong follows its host."""
    long_side = "<div class='extra'><p>" + "Unrelated teaser text that is quite long. " * 9 + "</div>"
    rows = [(i, "http://h.com/a", page(close="</div>" + long_side.replace("9", "1")[:60] + "</div>")) for i in range(6)]
    rows.append((9, "http://h.com/b", page(body="<p>Short.", close="</div>" + long_side)))
    rows += [(10, None, None), (11, "http://h.com/c", ""), (12, "http://x.com/", "plain"), (9, "http://h.com/b", page(body="<p>Short.", close="</div>" + long_side))]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id int, url string, html string, winners int")
    out = html_extract.extract(df)
    assert out.columns == ["page_id", "url", "html", "winners", "text", "text_path"]
    got = {r.page_id: r.text for r in out.collect()}
    assert out.count() == len(rows)
    assert got[9] == "Short." and got[10] == got[11] == "" and got[12] == "plain"
    assert html_extract.extract(df.limit(0)).count() == 0


def test_articles_of_the_test_pages(spark):
    """Every page is made from a document: title, then its lines."""
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    number = F.regexp_extract("url", r"/([0-9]+)", 1).cast("bigint")
    joined = queries.op10_html_extract(spark, sf).withColumn("doc", number).collect()
    assert len(joined) == pages.count()
    for r in joined:
        lines = [" ".join(x.split()) for x in docs[r.doc].split("\n")]
        assert r.text.split("\n\n", 1)[1] == "\n\n".join(x for x in lines if x)
        assert r.n_chars == len(r.text)


def test_url_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = queries.op3_url_templates(spark, sf).collect()
    assert len(rows) == 50
    assert all(r.rule == slow_rule(r.host, r.path) for r in rows)
    assert all(r.verdict == RULES[r.rule] for r in rows if r.rule)


def test_templates_against_sql(spark, same, tmp_path):
    """Random trees with variable segments, bad branches, deep paths and missing labels."""
    random.seed(6)
    rows, labels = [], []
    for i in range(3000):
        host = random.choice(["a.com", "a.com", "b.com", "c.org", "WWW.d.net"])
        branch = random.choice(["news", "promo", "deadbeef01", "x"])
        path = [branch, "".join(random.choices("bcdfghkmnp", k=5))]
        path += random.choices(["p", "q7", "r"], k=random.choice([0, 1, 6]))
        url = f"http://{host}/{'/'.join(path)}/{i}{random.choice(['', '.html', '/', '?a=b'])}"
        rows.append((i, random.choice([url] * 30 + [None, "", f"x://{host}"]), "h"))
        bad = branch == "promo" and host == "a.com" and random.random() < 0.9
        if random.random() < 0.5:
            labels.append((i, int(not bad), int(random.random() < 0.02)))
    labels += [(1, 0, 0), (2, None, 0), (None, 1, 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    known.write.parquet(str(tmp_path / "labels.parquet"))
    got = queries.op3_url_templates(spark, str(tmp_path))
    same(got, oracle.OP3, pages=pages, labels=known)
    assert {"block", "allow"} == {r.verdict for r in got.where("host = 'a.com'").collect()}
    assert any("*" in r.template for r in got.collect())


RUN = "A paragraph of running text that goes on for a while, with words."


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (f'<article><div class="article-header"><h1>Title</h1></div><p>{RUN}</article>', ["Title", RUN]),
        (f'<article><p>{RUN} 1<p class="reply">{RUN} 2</article>', [RUN + " 1", RUN + " 2"]),
        (f'<article><p>{RUN}</p><div class="share-price"><p>{RUN} 2</p></div></article>', [RUN, RUN + " 2"]),
        (f'<article><p>{RUN}</p><div class="share-tools"><p>Post it</p></div></article>', [RUN]),
        (f'<article><p>{RUN}<p class="ad">Buy this now, it is really cheap today.</article>', [RUN]),
        (f'<article><p>{RUN}</p><div class="user-comments">{f"<p>{RUN} no" * 9}</div></article>', [RUN]),
        (
            f'<div class="post-title"><h1>T</h1></div><div class="post-body"><p>{RUN}<p>{RUN}</div>'
            f'<div class="post-more"><p>{RUN} more</div><div class="links"><a href=x>{RUN}</a></div>',
            ["T", RUN, RUN, RUN + " more"],
        ),
        (
            f'<div class="story"><p>{RUN} 1<blockquote><p>{RUN * 4}<p>{RUN * 2}</blockquote><p>{RUN} 2</div>'
            '<div class="ad">buy</div>',
            [RUN + " 1", RUN * 4, RUN * 2, RUN + " 2"],
        ),
        (f'<div class="widget"><p>{RUN}<p>{RUN}<p>{RUN}</div><p>note</p>', [RUN] * 3),
        ('<p>unbalanced <a title="x>quote</a> here</p>', ["unbalanced quote here"]),
    ],
)
def test_words_do_not_decide_alone(html, want):
    assert html_extract.Page(f"<body><nav>menu</nav>{html}<footer>f</footer></body>").article([])[0] == "\n\n".join(want)


@pytest.mark.parametrize(
    "html",
    [
        "<div>" * 200_000 + RUN, "<a x" * 250_000, '<a x="' * 150_001 + ">", "<b>" * 100_000 + "</i>" * 100_000,
        "<b>" * 80_000 + "<p>x" * 80_000, "<i><div>" + "<b>" * 80_000 + "</i>" * 80_000, "<!--" * 250_000,
        "<div><p>x" * 60_000, "<table><tr><td>x" * 40_000, "<div class=share>x" * 40_000, "<li>x" * 100_000,
        "<h1>" * 100_000 + "x", "<p class='a" * 50_000,
    ],
)
def test_malformed_pages_take_time_in_proportion(html):
    """Some hundred kilobytes of each fault; a cost that grows as the square would take minutes."""
    start = time.process_time()
    html_extract.Page(html).article([])
    assert time.process_time() - start < 20


def test_pages_by_construction():
    """Random pages put together from parts whose place is known."""
    rng = random.Random(12)
    serial = iter(range(10**9))

    def text():
        return f"Sentence {next(serial)} with enough words to be running text."

    junk = [
        lambda: f"<nav><ul><li><a href=#>{text()}</a></ul></nav>", lambda: f"<aside><p>{text()}</aside>",
        lambda: f"<div class='cookie-notice'>{text()}</div>", lambda: f"<form>{text()}<input></form>",
        lambda: f"<div id=comments><p>{text()}<p>{text()}</div>", lambda: f"<script>var x = '{text()}'</script>",
        lambda: f"<!-- {text()} -->", lambda: f"<section class='related posts'><p>{text()}</section>",
    ]

    def blocks(depth, want):
        out = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.randint(0, 6)
            if kind == 0 and depth:
                tag = rng.choice(["div", "section", "blockquote"])
                out.append(f"<{tag} class='{rng.choice(['x1', 'part', 'share-price', 'c'])}'>{blocks(depth - 1, want)}</{tag}>")
            elif kind == 1:
                items = [text() for _ in range(rng.randint(1, 3))]
                want += items
                out.append("<ul>" + "".join(f"<li>{i}" for i in items) + "</ul>")
            elif kind == 2:
                out.append(rng.choice(junk)())
            else:
                want.append(text())
                out.append(f"<p>{want[-1].replace('enough', '<b>enough</b>')}")
        return "\n".join(out)

    for _ in range(300):
        want = [text()]
        inner = f"<h1>{want[0]}</h1>" + blocks(2, want)
        tag = rng.choice(["article", "main", "div class=entry"])
        sides = ["".join(j() for j in rng.sample(junk, rng.randint(0, 4))) for _ in range(2)]
        html = f"<html><body>{sides[0]}<{tag}>{inner}</{tag.split()[0]}>{sides[1]}<footer>{text()}</footer>"
        assert html_extract.Page(html).article([])[0].split("\n\n") == want, html


def test_deep_paths_are_judged_in_their_whole_depth(spark):
    """A bad branch below the sixth segment is blocked, its good neighbour is not."""
    rows = [
        (i, f"http://h.com/a/b/c/d/e/f/{'good' if i % 2 else 'bad'}/p{i}", None if i < 40 else bool(i % 2))
        for i in range(400)
    ]
    pages = spark.createDataFrame(rows, "page_id int, url string, __good boolean")
    got = url_templates.judge_urls(pages.withColumn("shapes", F.lit(1)), {}, good=F.col("__good"))
    assert {(r.page_id % 2, r.verdict) for r in got.collect()} == {(0, "block"), (1, "allow")}
    assert got.columns[:4] == ["page_id", "url", "__good", "shapes"]
    assert url_templates.judge_urls(pages.limit(0), {}).count() == 0
