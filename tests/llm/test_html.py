import html
import re

import pytest

from abtest_spark.llm.html_blocks import extract_pages, main_text

LONG = "It was the best of times, it was the worst of times, it was the age of wisdom, it was the age of foolishness, and so on."


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("<p>", ""),
        ("<html><body></body></html>", ""),
        ("<article><h1>T</h1><p>a &amp; b&nbsp;c</p><p>x\n\t y<br>z</article>", "T\na & b c\nx y\nz"),
        ("<article><p>a<p>b<b>c</b><i>d</i></article><p>out", "a\nbcd"),
        ("<nav><p>menu</nav><main><p>kept</main><footer>c</footer>", "kept"),
        ("<article><p>kept<div class='ad'>buy</div><form><p>name</form><script>x='</p>'</script><p>more</article>", "kept\nmore"),
        ("<article><p>kept</article><section id='comments'><article><p>I say</article></section>", "kept"),
        ("<article><p>kept</article><article class='comment'><p>I say</article>", "kept"),
        ("<article><!-- <p>no</p> --><p>a<![CDATA[b<c]]></p><p>1 < 2 & 3</article>", "ab<c\n1 < 2 & 3"),
        ("<article><p>&lt;b&gt; &#233;&#xe9; &eacute;&unknown; &copy</article>", "<b> éé é&unknown; ©"),
        ("<article class='has-sidebar'><header class='post-header'><h1>T</h1></header><p>b</article>", "T\nb"),
        ("<article><p style='display:none'>no<p hidden>no</p><p>yes</article>", "yes"),
        ("<ARTICLE><P>Up</P><STYLE>p{}</STYLE></ARTICLE>", "Up"),
        ("<article><p>cut short <a href='x", "cut short <a href='x"),
        ("<article><svg><title>t</title><p>kept</article>", "kept"),
        ("<article><p>a</p><object data=x>no<p>kept<canvas>no</p><p>more</article>", "a\nkept\nmore"),
        ("<article><p>a</p><svg><text>no</text></svg><p>kept</p><script>x<p>no</article>", "a\nkept"),
    ],
)
def test_structure(page, text):
    assert main_text(page) == text


def test_two_passes_without_an_article_element():
    page = f"""<body><div class="cookie-notice"><p>{LONG}</p></div><div><a href="/">Home</a> <a href="/n">News of the day</a></div>
    <div id="content"><h2>Title</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>
    <div class="comments"><p>{LONG}</p></div><div><p>Terms 2020</p></div><div><a href="/t">Terms of the use of this site</a></div>"""
    assert main_text(page) == f"Title\n{LONG}\nShort.\n{LONG}"


def test_short_blocks_take_the_label_of_both_neighbours():
    links = '<div><a href="x">all of it is a link to the other pages</a></div>'
    assert main_text(f"<p>{LONG}</p><p>between</p><p>{LONG}</p>") == f"{LONG}\nbetween\n{LONG}"
    assert main_text(f"{links}<p>edge</p>{links}<p>{LONG}</p>") == LONG


def test_pathological_pages_end():
    for page in ("<a " * 50_000, "<p " + '"' * 20_000, "<!--" * 20_000, "<" * 100_000, "<div>" * 20_000 + LONG, "&" * 50_000):
        main_text(page)


def test_pages_with_nulls_and_clashing_columns(spark):
    rows = [(1, "u", "<article><p>a</article>"), (1, "u", "<article><p>a</article>"), (None, None, "<article>é😀</article>"), (2, "u", None), (3, "u", "")]
    df = spark.createDataFrame([(*r, "t", 9) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    out = extract_pages(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "é😀", 2), (2, "u", "", 0), (3, "u", "", 0)], key=str
    )
    assert extract_pages(df.limit(0)).count() == 0


def test_query_against_the_article_elements(spark):
    from abtest_spark.llm.queries import QUERIES

    d = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    got = QUERIES["op8_main_text"](spark, d).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search("<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", inner)]
        want = "\n".join(p for p in parts if p)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


def test_density_rules_run_beside_an_article_element():
    """A teaser or widget in an article element does not stand for the page; long text beside an article is kept."""
    card = "<article class='card'><h3>Another story</h3><p>Read on</p></article>"
    assert main_text(f"<div class='content'><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div>{card}<footer>f</footer>") == f"T\n{LONG}\n{LONG}"
    intro = f"{LONG} {LONG}"
    assert main_text(f"<div><p>{intro}</p></div><article><p>{intro}</p><p>a</p></article><p>out</p>") == f"{intro}\n{intro}\na"
    assert main_text(f"<div><p>{intro}</p></div><article><p>{LONG}</p></article>") == f"{intro}\n{LONG}"
    links = "<p><a href='x'>one of the other stories</a></p>"
    assert main_text(f"<article><p>{LONG}</p>{links}<p>more</p>{links}</article>") == LONG


def test_text_without_known_stop_words_is_undecided():
    polish = "Litwo! Ojczyzno moja! ty jesteś jak zdrowie; ile cię trzeba cenić, ten tylko dowie, kto cię stracił. " * 3
    text = polish.strip()
    assert main_text(f"<nav>n</nav><div><p>{polish}</p><p>{polish}</p></div><footer>f</footer>") == f"{text}\n{text}"
    assert main_text(f"<div><p>{LONG}</p><p>{polish}</p><p>{LONG}</p></div>") == f"{LONG}\n{text}\n{LONG}"


def test_article_elements_renamed(spark):
    """The sf0.1 pages with article turned into div: the rules find the same text without the element."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("html").collect()]
    kept = whole = found = same = 0
    for p in pages:
        want, got = main_text(p).split("\n"), main_text(re.sub("(</?)article>", r"\1div>", p)).split("\n")
        both = set(want) & set(got)
        kept += sum(len(x) for x in want if x in both)
        whole, found, same = whole + sum(map(len, want)), found + sum(map(len, got)), same + (want == got)
    assert kept >= 0.97 * whole and kept >= 0.99 * found and same >= 0.9 * len(pages), (kept, whole, found, same)


@pytest.mark.parametrize("quote", ["'", '"'])
@pytest.mark.parametrize("size", [4096, 4097, 1_000_000])
def test_attribute_values_of_any_length(quote, size):
    value = quote + "x>y<" * (size // 4) + "z" * (size % 4) + quote
    page = f"<nav data-a={value}>menu</nav><article data-props = {value} id=a><p>a<img src={value}>b</p></article><div class=ad title={value}>buy</div>"
    assert main_text(page) == "ab"


def test_tags_without_an_end_are_text_and_end_soon():
    assert main_text("<article><p>a <b title=it's>b</b> <i x='y>c</i></article>") == "a b <i x='y>c"
    for page in ('<p a="' + ' a="<p"' * 100_000, "<p a='<p b=\"" * 50_000, "<p a=" + "<p a='x' " * 50_000):
        main_text(page)


@pytest.mark.parametrize("name", ['id="social-history"', 'class="legal-news-story"', 'class="post-tags-wide"', 'id="x" class="share_price_report"'])
def test_a_boilerplate_word_in_a_longer_name_is_no_verdict(name):
    """The element that holds the story keeps it; the same name beside a story is boilerplate."""
    story = f"<p>{LONG}</p><p>{LONG} And more.</p>"
    want = f"{LONG}\n{LONG} And more."
    assert main_text(f"<body><nav><a href=/>Home</a></nav><div {name}>{story}</div><footer>c</footer></body>") == want
    assert main_text(f"<body><article>{story}</article><div {name}><p>{LONG}</p></div></body>") == want
    assert main_text(f"<body><div id=content>{story}</div><div {name}><p>{LONG}</p></div></body>") == want


@pytest.mark.parametrize("name", ["comments-wide", "reader-comment-list", "cookie-notice", "sidebar", "social_share"])
def test_names_that_stay_verdicts(name):
    assert main_text(f"<body><div class='{name}'><p>{LONG}</p><p>{LONG}</p></div></body>") == ""
