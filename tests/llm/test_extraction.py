import html
import random
import re

from tablespan.llm import extraction
from tablespan.llm.markup import read_page
from tests.llm.frames import given, written

SCHEMA = "page_id long, url string, html string, host string, text string, mains string, of_host string"


def plain(page):
    """The article of a given page, whose markup is known."""
    article = re.search(r"<article>(.*?)</article>", page or "", re.S)
    parts = re.split(r"</?(?:p|h1|br)>", article[1]) if article else []
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts]
    return "\n\n".join(x for x in texts if x)


def run(spark, tmp_path, rows):
    frame = spark.createDataFrame([(*r, "h", "t", "m", "o") for r in rows], SCHEMA).repartition(4)
    result = extraction.op13_html_extraction(spark, written(tmp_path, pages=frame)).collect()
    assert len(result) == len(rows) and all(r.n_chars == len(r.text) for r in result)
    return sorted([(r.page_id, r.url, r.text) for r in result], key=repr)


def test_given_pages(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        pages = {r["page_id"]: r for r in given("pages", folder)}
        result = extraction.op13_html_extraction(spark, folder).collect()
        assert len(result) == len(pages)
        assert all((r.url, r.text) == (pages[r.page_id]["url"], plain(pages[r.page_id]["html"])) for r in result)


def words(draw, n):
    return " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(n)) + "."


def shop(draw, i, paragraphs):
    """A page without an article element, with fixed texts and reader comments."""
    body = "".join(f"<p>{p}" for p in paragraphs)
    menu = "".join(f'<li><a href="/{k}">{words(draw, 2)}</a>' for k in range(draw.randint(2, 9)))
    remarks = "".join(f"<div><p>{words(draw, 30)}</div>" for _ in range(draw.randint(0, 6)))
    return (
        f'<html><body class="has-sidebar"><div class=top><ul class="main-menu">{menu}</ul></div><div id="left-sidebar"><p>{words(draw, 60)}</div>'
        f"<div class='page id-{i}'><div class=story><h2>{words(draw, 3)}</h2><div class=hint>Read our best stories first.</div>{body}</div>"
        f'<div class="reader-comments">{remarks}</div></div><div class=legal>All rights reserved.</div>'
    )


def test_template_of_a_host(spark, tmp_path):
    draw = random.Random(3)
    rows, want = [], []
    for i in range(30):
        paragraphs = [words(draw, draw.randint(5, 60)) for _ in range(draw.randint(1, 6))] + ["A passage that many pages quote."] * (i % 3 == 0)
        page = shop(draw, i, paragraphs)
        rows.append((i, f"https://Shop.example.com:80/{i}", page))
        title = re.search("<h2>(.*?)</h2>", page)[1]
        want.append((i, rows[-1][1], "\n\n".join([title, *paragraphs])))
    assert run(spark, tmp_path, rows) == sorted(want, key=repr)


def test_copies_are_no_template(spark, tmp_path):
    page = "<body><article><h1>One</h1><p>The same text.</p></article></body>"
    rows = [(i, "http://copies.example.com/", page) for i in range(40)]
    assert {t for _, _, t in run(spark, tmp_path, rows)} == {"One\n\nThe same text."}


ODD = [
    (None, ""),
    ("", ""),
    ("just text &amp; more &lt;b&gt;", "just text & more <b>"),
    ("<p>a  b\n\tc&nbsp;d<br>e<p>f", "a b c d e\n\nf"),
    ("<article><p>x<script>var a='</p>';</script>y</p><style>p{}</style><!-- <p>no</p> -->z</article>", "xy\n\nz"),
    ("<main><p>in</p><aside>out</aside><form><p>out</p></form><div class='ad'>out</div><section class=comments>out</section></main><p>out", "in"),
    ("<article><header><h1>T</h1></header><p>b</p><footer>f</footer></article><header>h</header>", "T\n\nb"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\n\nb\n\nc\n\nd"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
    ('<p title="a > b">one</p><p title=\'"\'>two</p><p>three</p><foo', "one\n\ntwo\n\nthree"),
    ("<p>1 < 2 && 3 > 2</p>", "1 < 2 && 3 > 2"),
    ("<p>a<b>b<i>c</b>d</i>e</p></div></p></b>f", "abcde\n\nf"),
    ("<SCRIPT>never closed <p>x", ""),
    ("<!-- never closed <p>x", ""),
    ("<nav><ul><li>menu</ul></nav>", ""),
    ("<p hidden>x</p><p aria-hidden=true>y</p><div role=navigation>z</div><p>kept &#233;&#x1F600;", "kept é😀"),
    ("<b>" * 3000 + "deep" + "</b>" * 3000, "deep"),
    ("<div>" * 3000 + "deep", "deep"),
    ("<article>" + "<p>long text &amp; more" * 40_000 + "</article>", "\n\n".join(["long text & more"] * 40_000)),
    ("<a '\"" * 20_000, ""),
]


def test_odd_pages(spark, tmp_path):
    rows = [(i, u, h) for i, (h, _) in enumerate(ODD) for u in (None, "no url", f"http://h{i}.example.com")] + [(None, None, ODD[3][0]), (3, None, ODD[3][0])]
    want = [(i, u, t) for i, (_, t) in enumerate(ODD) for u in (None, "no url", f"http://h{i}.example.com")] + [(None, None, ODD[3][1]), (3, None, ODD[3][1])]
    got, want = run(spark, tmp_path, rows), sorted(want, key=repr)
    assert [g for g, w in zip(got, want, strict=True) if g != w] == []


def test_paths_and_regions():
    page = read_page("<article class='b a post-12'><p>x</p></article><article class='a b'><p>y<a href=''>zz</a></p></article>")
    assert len({b.path for b in page.blocks}) == 1 and len(page.regions) == 1
    assert [(b.text, b.linked) for b in page.blocks] == [("x", 0), ("yzz", 2)]
    assert max(page.elements.values()) == 2


def test_no_pages(spark, tmp_path):
    assert run(spark, tmp_path, []) == []
