"""Main text of pages: odd markup, noise by tag and class, and templates by recurrence."""

import random
import time

from newsloom.llm import template_html as op

CASES = [
    (None, ""), ("", ""), ("   ", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\n\nb"),
    ("<html><head><title>T</title><style>p{}</style></head><body><nav><a>m</a></nav><article><h1>A &amp; B</h1><p>x<br>y  <b>z</b></p></article><footer>f</footer>", "A & B\n\nx y z"),
    ("<article><p>one</p><div class='ad'>buy<p>now</p></div><aside>s</aside><p>two &eacute;&#8217;&#x41;&nbsp;x</p><form>q</form></article>", "one\n\ntwo é’A x"),
    ("<article><p>one</p><div class=\"notice cookie-bar\">n</div><section id=comments><p>c</p></section><p>t<span class=ad>x<span>y</span></span>u</p>", "one\n\nt u"),
    ("<body><div class='site-header'>h</div><div id='main-menu'>m</div><main><p>in</p></main><p>out</p>", "in"),
    ("<body><header><h1>Site</h1></header><div><p>a</p>tail</div><!-- c --><script>var t='</p>'</script>", "a\n\ntail"),
    ("<article><header><h1>Title</h1></header><ul><li>a<li>b</ul><table><tr><td>1<td>2</table></article>", "Title\n\na\n\nb\n\n1\n\n2"),
    ("<article><p>cut &am", "cut &am"), ("<article><p>cut <a hre", "cut"), ("<article><p>x</p><script>never closed <p>y", "x"), ("<article>a < b > c</article>", "a < b > c"),
    ("<div hidden>no</div><p>yes</p><p aria-hidden='true'>no</p>", "yes"), ("<article><p>a</p></article><article class='comment'><p>c</p></article><article><p>b</p></article>", "a\n\nb"),
    ("<article><p title='a>b'>quoted</p><!-- unclosed", "quoted"), ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"), ("<article><p></p><p> </p></article>", ""),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<article><p>downloads and thread</p></article>", "downloads and thread"),
]


def test_text_of_single_pages():
    for html, text in CASES:
        assert op.text_of(html) == text, html


WRAPPED = [
    ("<div class='content has-sidebar'><article><p>a</p></article><div class='sidebar'>s</div></div>", "a"),
    ("<div class='no-sidebar'><p>a</p></div><div class='post with-comments'><p>b</p></div><div class='no-js menu'>m</div><div class='sidebar-no-border'>s</div>", "a\n\nb"),
    ("<div class='layout--has_left_sidebar'><p>a</p></div><div class='has-ad ad'>x</div>", "a"),
    ("<div id=sidebar-layout><div class='related nav'><main><p>a</p></main></div></div><div class=related><p>r</p></div>", "a"),
    ("<div id='page-header'><div class='share'><article><div class='ad'>x</div><p>a</p></article></div></div>", "a"),
    ("<article class='comments-open'><main><p>a</p></main></article>", "a"),
    ("<p>a</p><section id=comments><article class='comment'><p>c</p></article></section>", "a"), ("<p>a</p><nav><div class=menu><article>m</article></div></nav>", "a"),
    ("<p>a</p><div hidden class='ad'><article>h</article></div><div role='dialog' class='modal'><main>d</main></div>", "a"),
    ("<app-root class='nav open'><main><p>a</p></main></app-root>", "a"), ("<p>a<span class=ad>x<!-- <article> --><script>'<main>'</script></span>b</p>", "a b"),
    ("<div class='no-ads'>" * 300 + "<div class='menu'>" * 300 + "<article>a</article>" + "</div>" * 600, "a"),
]


def test_noise_by_class_does_not_take_the_article_with_it():
    for html, text in WRAPPED:
        assert op.text_of(html) == text, html


STORIES = [
    ("<main><h1>T</h1><p>long main text</p></main><article><p>teaser</p></article>", "T\n\nlong main text"),
    ("<div class=content><h1>Story</h1><p>The whole story, told here.</p></div><article><h2>More</h2></article>", "Story\n\nThe whole story, told here.\n\nMore"),
    ("<div class='post-12 post category-social tag-search'><p>The whole story.</p></div>", "The whole story."),
    ("<div id='alerts-and-notices-explained' class='story'><p>The whole story.</p></div>", "The whole story."),
    ("<main><article><p>an article of the main part</p></article><p>tail</p></main><p>out</p>", "an article of the main part"),
    ("<p>a</p><div class='ad-slot'>x</div><div class='cookie-consent-banner'>y</div><div class='related-posts'>z</div><ul class='social-links'><li>w</ul>", "a"),
    ("<p>a</p><div class='advice'>b</div><div class='shared-notes'>c</div><div class='searching'>d</div>", "a\n\nb\n\nc\n\nd"),
]


def test_stories_are_kept():
    for html, text in STORIES:
        assert op.text_of(html) == text, html


LONG = {
    "open noise": "<p>start</p>" + "<span class='ad'>x" * 50_000,
    "closed noise": "<span class='ad'>" * 50_000 + "</span>" * 50_000 + "<p>end</p>",
    "noise around articles": "<b class='ad'>" * 20_000 + "<article>a</article>" + "</b>" * 20_000,
    "unmatched quotes": "<p>start</p>" + '<a "x ' * 100_000,
    "unmatched quotes before an end": "<p>start</p>" + "<a \"x ' " * 100_000 + ">'\">",
    "open divs": "<div>" * 50_000 + "</section>" * 50_000 + "deep",
    "many names": "".join(f"<x{i} class=ad>y</x{i}>" for i in range(50_000)) + "<p>end</p>",
    "one line": "<p>" + "word " * 1_000_000,
}


def test_long_pages_take_time_in_proportion():
    for name, html in LONG.items():
        start = time.time()
        op.text_of(html)
        assert time.time() - start < 15, name


def plain_templates(rows, least):
    """Hashes that recur on pages of a host that differ, by a plain count; and each page's text without them."""
    counts = {}
    for _, url, html in rows:
        blocks, hashes = op.walk(html or "")
        host = (url or "").split("://", 1)[1].split("/", 1)[0].lower() if "://" in (url or "") else ""
        for h in set(hashes):
            counts.setdefault((host, h), set()).add("\n".join(blocks))
    out = {}
    for i, url, html in rows:
        host = (url or "").split("://", 1)[1].split("/", 1)[0].lower() if "://" in (url or "") else ""
        found = frozenset(h for (k, h), texts in counts.items() if k == host and len(texts) >= least)
        out[i] = "\n\n".join(op.walk(html or "", found)[0])
    return out


def test_templates_against_a_plain_count(spark):
    rnd = random.Random(1)
    parts = [f"<div><p>part {k}</p><ul><li>x{k % 3}</li></ul></div>" for k in range(12)]
    rows = [(i, f"http://h{rnd.randrange(3)}.org/{i}", "<body>" + "".join(rnd.sample(parts, 4)) + f"<div><p>Own words of page {i % 40}.</p></div></body>") for i in range(60)]
    got = {r.page_id: r.text for r in op.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    assert got == plain_templates(rows, op.LEAST_PAGES)


def pages():
    rows = []
    for i in range(12):
        shared = "<p>A passage that many articles of this site quote in full.</p>"
        body = f"<article><h1>Title {i}</h1>{shared}<p>Own text {i}.</p><div><div>Read <a>more of our stories</a></div></div></article>"
        rows.append((i, f"http://a.example.org/en/{i}", f"<body><div><ul><li>Home</li></ul></div>{body}<div>Imprint</div></body>"))
    for i in range(12, 24):  # no article element: only recurrence tells
        rows.append((i, f"http://B.example.org/{i}?x", f"<body><div><p>Welcome to our site</p></div><div><p>Story {i} begins.</p><p>And ends {i}.</p></div></body>"))
    for i in range(24, 36):  # copies of one page are one page
        rows.append((i, "http://copies.example.org/", "<body><div><p>Copied text.</p></div></body>"))
    rows += [(40, None, "<p>no url</p>"), (41, "x", None), (None, "http://lone.org/", "<div><p>alone</p></div>"), (0, "http://a.example.org/en/0", rows[0][2])]
    return rows


def test_templates_go_by_host(spark):
    table = spark.createDataFrame([(*r, "t", 3) for r in pages()], "page_id long, url string, html string, text string, n_chars int").repartition(4)
    got = op.extract(table)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert len(rows) == len(pages()) and all(r.n_chars == len(r.text) for r in rows)
    text = {r.page_id: r.text for r in rows}
    for i in range(12):
        assert text[i] == f"Title {i}\n\nA passage that many articles of this site quote in full.\n\nOwn text {i}."
    for i in range(12, 24):
        assert text[i] == f"Story {i} begins.\n\nAnd ends {i}."
    assert {text[i] for i in range(24, 36)} == {"Copied text."}
    assert text[40] == "no url" and text[41] == "" and text[None] == "alone"


def test_templates_do_not_depend_on_the_size_of_the_host(spark):
    page = lambda i, block: (i, "http://big.example.org/" + str(i), f"<body>{block}<div><p>Story {i} begins.</p><p>And ends {i}.</p></div></body>")
    rows = [page(i, f"<div><ul><li>Section {i // 5}</li></ul></div>") for i in range(200)]  # each on 5 of 200 pages, a 40th
    rows += [page(i, f"<div><p>Only on three {(i - 200) // 3}</p></div>") for i in range(200, 206)]
    rows += [(1000 + i, "http://big.example.org/same", "no block") for i in range(300)]
    text = {r.page_id: r.text for r in op.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    assert len(text) == len(rows) and {text[1000 + i] for i in range(300)} == {"no block"}
    for i in range(200):
        assert text[i] == f"Story {i} begins.\n\nAnd ends {i}."
    for i in range(200, 206):
        assert text[i] == f"Only on three {(i - 200) // 3}\n\nStory {i} begins.\n\nAnd ends {i}."


def test_empty_table(spark):
    assert op.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
