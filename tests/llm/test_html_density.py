from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus
from martworks.llm import html_density as H

LONG = "This paragraph has a number of words that make it look like the text of an article, which it is."
HEAD = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='<p>no</p>';</script></head>"


def around(article: str) -> str:
    return (HEAD + "<body class='has-sidebar'><header><a href='/'>Site</a> Tagline of the site</header><nav><ul><li><a href='/a'>A</a></li>"
            "<li><a href='/b'>B</a></li></ul></nav><div id='cookie-notice'>We use cookies and a long sentence to say so to you.</div>"
            f"<form><input name=q><button>Search</button></form>{article}<aside><p>{LONG} aside</p></aside>"
            f"<div class='sidebar widget'><p>{LONG} side</p></div><div class='ad'>Buy {LONG}</div>"
            f"<section id=comments><article class=comment><p>{LONG} reader</p></article></section><footer>&copy; x</footer></body></html>")


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div id=content>{}</div>", "<div><div class='post'>{}</div></div>"])
def test_only_the_article(wrap):
    inner = f"<h1>A  title &amp; more</h1>\n<p>{LONG}<p>Second <b>bold</b> and <a href=x>linked</a>&nbsp;text,<br>next line. {LONG}<ul><li>one {LONG}<li>two {LONG}</ul><!-- no --><script>no()</script><p>{LONG} end"
    want = ["A title & more", LONG, f"Second bold and linked text, next line. {LONG}", f"one {LONG}", f"two {LONG}", f"{LONG} end"]
    assert H.main_text(around(wrap.format(inner))) == "\n".join(want)


@pytest.mark.parametrize("source, want", [
    (None, ""), ("", ""), ("   ", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>one</p>", "one"), ("a < b and c > d", "a < b and c > d"),
    (HEAD + "<body></body></html>", ""), (HEAD + "<body><script>x</script></body>", ""),
    ("<body><p>cut off in a <b>tag</b> <a hre", "cut off in a tag"), ("<body><article><h1>t</h1><p>x &am", "t\nx &am"),
    ("<body><article><p>a<!-- never closed", "a"), ("<article><p>&#233;&eacute;&#x1F642; &notanentity;</p></article>", "éé🙂 ¬anentity;"),
    ("<article><header><h1>In</h1></header><p>b</p><footer>f</footer></article>", "In\nb"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"), ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>", "yes"),
    ("</div></p><article>x</section>y</article>z", "xy"), ("<ARTICLE><P CLASS=\"Ads\">no</P><P TITLE=\"a > b\">yes</P></ARTICLE>", "yes")])
def test_odd_pages(source, want):
    assert H.main_text(source) == want


def test_deep_and_broken_pages_end():
    assert H.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert H.main_text("<a <a " * 20_000 + ">") == ""
    assert H.main_text("<" * 50_000 + "x").count("<") >= 0


def test_links_lower_the_density():
    page = H.parse(f"<body><div><p>{LONG}</p></div><div><p><a href=x>{LONG}</a></p></div></body>")
    body = page.children[0]
    H._measure(H._walk(body))
    plain, linked = body.children
    assert H._density(plain, body) > 3 * H._density(linked, body) >= 0


def test_every_row(spark):
    pages = [(1, "u", around(f"<article><p>{LONG}</p></article>")), (1, "u", around(f"<article><p>{LONG}</p></article>")), (None, None, None),
             (2, None, ""), (3, "v", "<p>" + corpus.sentence(corpus.random.Random(0), 50_000)), (4, "w", "<p>é🙂")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"text": F.lit("t"), "n_chars": F.lit("x")})
    got = [tuple(r) for r in H.extract(df).collect()]
    want = [(i, u, t := H.main_text(h), len(t)) for i, u, h in pages]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r[3] for r in got if r[0] == 4} == {2}
    assert H.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("body, want", [
    ("<div><article>" + "<p>{0} a</p>" * 6 + "</article><article>" + "<p>{0} b</p>" * 4 + "</article></div>", ["{0} a"] * 6 + ["{0} b"] * 4),
    ("<div><h1>{0} head</h1>" + "<p>{0} lead</p>" * 2 + "<article>" + "<p>{0} a</p>" * 4 + "</article></div>", ["{0} head"] + ["{0} lead"] * 2 + ["{0} a"] * 4),
    ("<article>" + "<p>{0} a</p>" * 4 + "</article><nav><p>{0} no</p></nav><div class=ad><p>{0} no</p></div>", ["{0} a"] * 4)])
def test_dense_parts_beside_the_article(body, want):
    assert H.main_text(HEAD + f"<body>{body.format(LONG)}</body></html>") == "\n".join(want).format(LONG)


RECORD = "<div class=r><{0}>Ann</{0}> <time>1 May</time><p>{1} c</p></div>"


@pytest.mark.parametrize("part, want", [
    # Names that articles have, too.
    ("<section id='related-work'><h2>Related</h2><p>{0} r</p></section>", ["Related", "{0} r"]), ("<p class='notice'>{0} n</p>", ["{0} n"]),
    ("<div class='share-price'>{0} p</div>", ["{0} p"]), ("<div id=safetyNotice>{0} s</div>", ["{0} s"]), ("<div class='no-ads'>{0} a</div>", ["{0} a"]),
    # Noise by name.
    ("<div class=feedback><p>{0} f</p></div>", []), ("<div class='fb-comments'><p>{0} c</p></div>", []), ("<div class='ad-box-2'>{0} a</div>", []),
    ("<div class='cookie-notice'>{0} c</div>", []), ("<div id=commentList>{0} c</div>", []), ("<p class=share><a href=x>{0} link</a></p>", []),
    # Readers' records by their make; sections with headings, dialogues and lists are text.
    ("<div class=below>" + RECORD.format("b", "{0}") * 3 + "</div>", []), ("<div>" + RECORD.format("h5", "{0}") * 2 + "</div>", []),
    ("<section id=discussion><div><b>Ann</b><p>{0} c</p></div><div><b>Bob</b><p>{0} d</p></div></section>", []),
    ("<section id=discussion><h2>Discussion</h2><p>{0} a</p><p>{0} b</p></section>", ["Discussion", "{0} a", "{0} b"]),
    ("<div><div><b>Ann</b><p>{0} c</p></div><div><b>Bob</b><p>{0} d</p></div></div>", ["Ann", "{0} c", "Bob", "{0} d"]),
    ("<div><section><h2>One</h2><time>1 May</time><p>{0} c</p></section><section><h2>Two</h2><time>2 May</time><p>{0} d</p></section></div>",
     ["One", "1 May", "{0} c", "Two", "2 May", "{0} d"])])
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div>{}</div>"])
def test_parts_inside_the_chosen_element(part, want, wrap):
    body = wrap.format("<h1>Head</h1>" + "<p>{0}</p>" * 8 + part + "<p>End {0}</p>")
    got = H.main_text(HEAD + f"<body><nav>n</nav>{body.replace('{0}', LONG)}<footer>f</footer></body></html>")
    assert got == "\n".join(["Head", *[LONG] * 8, *[w.replace("{0}", LONG) for w in want], f"End {LONG}"]).replace("<time>", "")


def test_vague_names_outside_of_the_chosen_element_are_noise():
    page = HEAD + "<body><p class=notice>{0} n</p><div id=x>" + "<p>{0}</p>" * 5 + "</div><p class='legal-notice'>{0} n</p></body>"
    assert H.main_text(page.replace("{0}", LONG)) == "\n".join([LONG] * 5)


def test_nested_records_take_linear_time():
    page = "<p>" + LONG * 3000 + "</p>" + "<div class=r><div class=r><b>Ann</b><time>1</time>x</div>" * 20_000
    assert LONG in H.main_text(page)
