"""HTML extraction: tree matching against brute force, pages with known texts."""

import json
import random
from functools import lru_cache

import pyarrow as pa

from quantleaf.llm import wrappers

from .helpers import SF

SHELL = ("<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href=/>Home</a></ul></nav>"
         "<div class='cookie-notice'><p>We use cookies</p></div>%s<aside>Side</aside><form><p>Join</p></form>"
         "<section id='comments'><p>First!</p></section><script>var a = '<p>no</p>';</script><footer><p>&copy; us</p></footer></body></html>")


def text_of(source):
    page = wrappers.parse(source)
    return wrappers.main_text(page, {}, wrappers.shape(page)[1], set(), None)


def test_known_pages():
    cases = [
        (None, ""), ("", ""), ("plain  text\n only", "plain text only"), ("<p>a<p>b<br>c", "a\nb\nc"), ("<p>cut &am", "cut &am"), ("<p>x</p><p cl", "x"),
        (SHELL % "<article><h1>T &amp; U</h1><p><b>One\n two<br><p>Three<ul><li>4<li>5</ul></article>", "T & U\nOne two\nThree\n4\n5"),
        (SHELL % "<main><p>Main</p><div class='ad'>Buy</div><p hidden>h</p></main>", "Main"),
        (SHELL % "<div class='post'><p>Posted</p></div><div><p>else</p></div>", "Posted"),
        ("<article><p>Story</p><div class='comment-list'><article class='comment'>bad</article></div></article>", "Story"),
        ("<div class='has-sidebar'><article><p>Told</p></article><div class='sidebar'>no</div></div>", "Told"),
        ("<article><p>Told</p></article><section class='comments'><article>bad</article></section>", "Told"),
        ("<div><p>no article</p><table><tr><td>a<td>b</table></div>", "no article\na\nb"),
        ("<a href='x>y'>q</a><p title=it's>z</p>", "q\nz"), ("<div>" * 500 + "deep" + "</div>" * 500, "deep"), ("</p></div>stray<!-- x", "stray"),
    ]
    for source, want in cases:
        assert text_of(source) == want, source


def test_raw_elements_end_at_their_end_tag():
    for raw in ("<script>for(i=0;i<n;i++){f()}</script>", "<script>a='<!--';if(a<b)c()</SCRIPT >", "<style>a<b{}</style\n>", "<textarea>a<b</textarea>",
                "<script>x='</scripts>'+\"<p title='\"</script>", "<title>a <b</title>", "<script src=a></script x='y'>"):
        assert text_of(f"<div>{raw}<article><p>Told</p></article><script>1</script></div>") == "Told", raw
    assert text_of("<p>Told</p><script>if(a<b)") == "Told"


def test_unclosed_head_and_hidden_elements():
    cases = [
        ("<head><title>t</title><body><article><p>Told</p></article>", "Told"), ("<html><head><meta x>\n<title>t</title><p>Told", "Told"),
        ("<head><script>1</script>\n Told <p>more", "Told\nmore"), ("<head><title>t</title></head>\n<body>Told", "Told"),
        ("<p>a <button><div>no</div></button> b</p>", "a b"), ("<p>a <svg><path d='x'/><text>no</text></svg>b<math/>c</p>", "a bc"),
        ("<div><object><p>no</p></object></div><p>b</p>", "b"), ("<select><option>no<option>no</select><button>no<button>no</button><p>b", "b"),
        ("<ul><li>a<select><option>no<li>b</ul>", "a\nb"), ("<button><ul><li>no<li>no</ul></button>b", "b"),
    ]
    for tag in ("button", "select", "svg", "math", "object"):
        cases += [(f"<body><div><{tag}>no</div><article><p>Told</p></article>", "Told"), (f"<p>One</p><{tag}>no<p>Two</p>", "One\nTwo"),
                  (f"<article><p>One <{tag}>no</p><p>Two</p></article><{tag}>no</{tag}>", "One\nTwo")]
    for source, want in cases:
        assert text_of(source) == want, source


def test_tree_matching_is_largest():
    rnd = random.Random(1)

    def tree(depth):
        return [rnd.choice("ab"), *[tree(depth - 1) for _ in range(rnd.randint(0, 3) if depth else 0)]]

    def freeze(t):
        return (t[0], tuple(freeze(c) for c in t[1:]))

    @lru_cache(maxsize=None)
    def best(x, y):
        if x[0] != y[0]:
            return 0
        return 1 + forest(x[1], y[1])

    @lru_cache(maxsize=None)
    def forest(x, y):
        if not x or not y:
            return 0
        return max(forest(x[1:], y), forest(x, y[1:]), best(x[0], y[0]) + forest(x[1:], y[1:]))

    for _ in range(200):
        a, b = tree(3), tree(3)
        found = wrappers.match_trees(a, b)
        assert len(found) == best(freeze(a), freeze(b))
        assert sorted(found.values()) == [found[k] for k in sorted(found)]      # keeps the order


def test_shape_joins_equal_siblings():
    shape, number = wrappers.shape(wrappers.parse("<div><p>a<p>b<h1>c</h1><p>d</div>"))
    assert json.loads(shape) == ["#", ["div", ["p"], ["h1"], ["p"]]]
    assert number == [0, 1, 2, 2, 3, 4]


def test_constant_slots_are_template(spark):
    rows = [(i, f"http://h{i % 2}.example.org/{i}", "<body><div><p>Share this page now</p></div><div><div>"
             f"<p>Story number {i} is about {i * 7} things.</p><p>It goes on for a while, {i}.</p></div></div></body>") for i in range(40)]
    rows += [(100, None, "<p>no host</p>"), (101, "not a url", None), (102, "http://h0.example.org/x", ""), (103, "http://h0.example.org/1", rows[0][2])] * 2
    pages = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "page_id long, url string, html string, host string, template string, number int")
    got = {r.page_id: r for r in wrappers.op4_query(pages).collect()}
    assert wrappers.op4_query(pages).count() == len(rows)
    for i in range(40):
        assert got[i].text == f"Story number {i} is about {i * 7} things.\nIt goes on for a while, {i}." and got[i].n_chars == len(got[i].text)
    assert (got[100].text, got[101].text, got[102].text, got[101].n_chars) == ("no host", "", "", 0)
    assert wrappers.op4_query(pages.limit(0)).collect() == []


def test_names_inside_an_article():
    cases = [(f"<{o}><p>One</p><section id='{i}'><h2 id='{i}-2'>H</h2><p>Two</p></section></{o}>", "One\nH\nTwo")
             for o in ("article", "main", "div role=main") for i in ("side-effects", "related-work", "legal-basis", "search-results")]
    cases = [(source.replace("</div role=main>", "</div>"), want) for source, want in cases]
    cases += [
        ("<article id='commentary-on-x'><h2 id='legal'>H</h2><p class='notice'>Two</p><div class='side-effects'>Three</div></article>", "H\nTwo\nThree"),
        ("<article><p>One</p><div class='ad'>no</div><div id='comments'>no</div><ul class='comment-list'><li>no</ul><div class='x share'>no</div></article>", "One"),
        ("<article><p>One</p><ul class='share-buttons'><li><a>no</a><li><a>no</a></ul><article id='comment-12'>no</article></article>", "One"),
        ("<section id='related-work'><p>no</p></section><article><p>One</p></article>", "One"),
    ]
    for source, want in cases:
        assert text_of(source) == want, source


def test_varying_text_below_a_name(spark):
    page = ("<body><article><p>Story %d</p><section id='legal'><h2>Law</h2><p>Paragraph %d applies.</p></section><div class='notice'>All of it</div>"
            "<div class='related'><a>Story %d too</a></div><div class='comments'>I say %d</div></article></body>")
    rows = [(i, f"http://h.example.org/{i}", page.replace("%d", str(i))) for i in range(20)]
    rows += [(20 + i, "http://few.example.org/", page.replace("%d", str(i))) for i in range(3)]
    got = {r.page_id: r.text for r in wrappers.op4_query(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(20):     # the constant heading is template
        assert got[i] == f"Story {i}\nParagraph {i} applies."
    assert [got[i] for i in range(20, 23)] == ["Story 0", "Story 1", "Story 2"]


def test_copies_of_an_article_are_no_template(spark):
    shell = "<body><div><p>Share this page now</p></div><div>%s</div><footer>%d</footer></body>"
    copy = "<article><h1>One story</h1><p>It is told often.</p></article>"
    rows = [(i, f"http://h.example.org/{i}", shell % (copy, i % 7)) for i in range(180)]        # 90 % of the host
    rows += [(i, f"http://h.example.org/{i}", shell % (f"<h2>Page {i}</h2><p>Its text is {i * 7}.</p>", i)) for i in range(180, 200)]
    rows += [(200 + i, f"http://few.example.org/{i}", shell % (copy if i < 20 else f"<p>Other text {i}</p>", i)) for i in range(23)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.op4_query(pages).collect()}
    assert len(got) == len(rows)
    assert {got[i] for i in range(180)} == {got[i] for i in range(200, 220)} == {"One story\nIt is told often."}
    for i in range(180, 200):
        assert got[i] == f"Page {i}\nIts text is {i * 7}."
    assert got[222] == "Share this page now\nOther text 22"      # four distinct pages show no template


def test_given_pages(spark):
    import html
    import re
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {}
    for r in pages.collect():
        body = r.html[r.html.find("<article>") + 9:].split("</article>")[0]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"<(?:/?p|/?h1|br)>", body))
        want[r.page_id] = "\n".join(b for b in blocks if b)
    assert {r.page_id: r.text for r in wrappers.op4_query(pages).collect()} == want


def test_text_hash_is_that_of_the_column(spark):
    from pyspark.sql import functions as F
    words = ["", "a", "été", "Share this page now"]
    got = [r.h for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w").alias("h")).collect()]
    assert got == [wrappers.text_hash(w) for w in words]


LAYOUTS = {
    "has-sidebar": "<div class='layout has-sidebar'>{head}{body}<div class='sidebar'><p>About us</p></div></div>",
    "share-page": "<div class='share-page'>{head}{body}</div>",
    "post-header": "<div class='wrap'><div class='post-header'>{head}</div><div class='post-body'>{body}</div></div>",
    "side-by-side": "<div class='side-by-side'><div>{head}{body}</div></div><div class='site-footer'><p>Imprint</p></div>",
    "with-header": "<div class='page with-header'><div class='site-header'><p>The site</p></div>{head}{body}</div>",
    "search-results": "<section id='search-results'>{head}{body}</section><div class='login-box'><p>Sign in</p></div>",
}


def layout_pages(rnd, layout, article, n=30):
    for i in range(n):
        words = lambda k: " ".join(rnd.choice("red blue green one two three sun moon sea sky".split()) for _ in range(k))
        head, body = f"Title {i} {words(4)}", [f"{words(rnd.randint(15, 40))} {i}.{k}" for k in range(rnd.randint(2, 5))]
        inner = LAYOUTS[layout].format(head=f"<h1>{head}</h1>", body="".join(f"<p>{p}</p>" for p in body))
        inner = f"<article>{inner}</article>" if article else inner
        yield ("<html><body><header>Site</header><nav><a href='/'>Home</a></nav><div class='cookie-banner'><p>We use cookies</p></div>" + inner +
               "<div class='comments-area'><p>" + words(60) + "</p></div><footer>us</footer></body></html>"), "\n".join([head, *body])


def test_names_give_way_to_varying_slots(spark):
    rnd, rows, want = random.Random(8), [], {}
    for layout in LAYOUTS:
        for article in (False, True):
            for source, text in layout_pages(rnd, layout, article):
                want[len(rows)] = (layout, article, text)
                rows.append((len(rows), f"http://{layout}-{article}.test/{len(rows)}".lower(), source))
    got = {r.page_id: r.text for r in wrappers.op4_query(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    missed = {(w[0], w[1]) for i, w in want.items() if not set(w[2].split("\n")) <= set(got[i].split("\n"))}
    assert not missed
    added = {}
    for i, (layout, article, text) in want.items():
        for line in set(got[i].split("\n")) - set(text.split("\n")):
            added.setdefault((layout, article), set()).add(line)
    assert all(lines <= {"About us", "The site"} for lines in added.values()), added      # constant words of a page's own frame at most
    assert sum(got[i] == w[2] for i, w in want.items()) >= 0.9 * len(want)


def test_a_name_never_drops_most_of_a_page():
    for name in ("layout has-sidebar", "share-page", "sidebar", "search", "page-notice"):
        assert text_of(f"<div class='{name}'><p>Told at some length</p></div><div class='menu-box'><a href=x>Home</a></div>") == "Told at some length"
    assert text_of("<p>Told</p><div class='comments'><p>A very long comment by a reader</p></div>") == "Told"
    assert text_of("<p>Told at length</p><div class='sidebar'><p>Side</p></div><div class='has-notice'><p>No</p></div>") == "Told at length"


def test_what_a_host_has_is_read_once():
    """Python reads a host's template and constants once for many pages, not once for each."""
    read = []
    rows = pa.RecordBatch.from_pydict({"host": ["a"] * 500 + ["b"] * 500, "template": ["x" * 100] * 500 + [None] * 500})
    wrapper, hosts = wrappers.Wrappers(template=lambda t: read.append(t) or t), rows.column("host").to_pylist()
    assert [wrapper(rows, hosts, i)[0] for i in range(1000)] == rows.column("template").to_pylist()
    assert len(read) == 2


def test_small_tables_are_written_by_few_tasks(spark, monkeypatch):
    """With 64 shuffle partitions that are not merged, the tables by host and by text have a file for each core at most."""
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, real, files = {k: spark.conf.get(k) for k in held}, wrappers.materialise, {}

    def stored(df, name, *more):
        out = real(df, name, *more)
        files[name] = len(out.inputFiles())
        return out

    monkeypatch.setattr(wrappers, "materialise", stored)
    rows = [(i, f"https://h{i % 40}.org/{i}", SHELL % f"<article><p>Story {i}</p></article>") for i in range(200)]
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.page_id: r.text for r in found} == {i: f"Story {i}" for i in range(200)}
    assert files.keys() == {"templates", "slots", "wrappers"} and max(files.values()) <= spark.sparkContext.defaultParallelism, files
