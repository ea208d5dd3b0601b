"""Scalar functions: dates, categories, ids, text helpers."""

from pyspark.sql import functions as F

from tidings.functions.categories import category_map, category_multi
from tidings.functions.dates import iso_utc, std_published
from tidings.functions.ids import article_id, zero_pad6
from tidings.functions.text import html_body, html_title, provider_domain, strip_wrapping_quotes, token_chunks


def one(spark, col, data=None, schema="x string"):
    df = spark.createDataFrame(data or [("",)], schema)
    return [r[0] for r in df.select(col).collect()]


def test_std_published_per_vendor(spark):
    data = [("2023-04-07T14:40:00.1234560Z", "bingnews"), ("2023-04-07T14:40:00Z", "newsapi.org"),
            ("2023-04-07T14:40:00.123456Z", "thenewsapi.com"), ("2023-04-07T14:40:00Z", "bingnews"),
            ("2023-04-07 14:40:00Z", "newsapi.org"), (None, "newsapi.org")]
    got = one(spark, iso_utc(std_published(F.col("x"), F.col("a"))), data, "x string, a string")
    assert got == ["2023-04-07 14:40:00.123456", "2023-04-07 14:40:00.000000", "2023-04-07 14:40:00.123456",
                   None, None, None]


def test_category_map(spark):
    data = [("ScienceAndTechnology", "bingnews"), ("Nope", "bingnews"), ("tech", "thenewsapi.com"),
            ("business", "newsapi.org"), (None, "bingnews")]
    got = one(spark, category_map(F.col("x"), F.col("a")), data, "x string, a string")
    assert got == ["science-and-technology", "n/a", "science-and-technology", "n/a", "n/a"]


def test_category_multi(spark):
    df = spark.createDataFrame([(["tech", "sports", "x"],)], "c array<string>")
    assert df.select(category_multi(F.col("c"), F.lit("thenewsapi.com"))).first()[0] == \
        "science-and-technology,sports,n/a"


def test_zero_padding_never_truncates(spark):
    got = one(spark, zero_pad6(F.col("i")), [(1,), (123456,), (1234567,)], "i long")
    assert got == ["000001", "123456", "1234567"]
    aid = one(spark, article_id(F.col("i"), F.lit("k")), [(1,)], "i long")[0]
    assert len(aid) == 43 and aid.startswith("000001#")


def test_strip_quotes(spark):
    got = one(spark, strip_wrapping_quotes(F.col("x")), [('"A title"',), ('"',), ('"half',), ("plain",)])
    assert got == ["A title", "", '"half', "plain"]


def test_token_chunks_keep_leading_space(spark):
    got = one(spark, token_chunks(F.col("x"), 2), [("Hello world good morning",)])
    assert got == [["Hello world", " good morning"]]


def test_provider_domain(spark):
    got = one(spark, provider_domain(F.col("x")), [("https://www.BBC.co.uk/news?x=1",), ("http://m.a.com:80/x",),
                                                   ("nonsense",)])
    assert got == ["bbc.co.uk", "a.com", ""]


def test_html_article(spark):
    html = ("<html><head><title>T &amp; U</title><script>var x='<p>';</script></head><body><nav>menu</nav>"
            "<article><h1>Head</h1><p>Body <b>text</b>.</p></article></body></html>")
    df = spark.createDataFrame([(html,), ("<html><body><script>x</script></body></html>",)], "h string")
    got = [(r[0], r[1]) for r in df.select(html_title(F.col("h")), html_body(F.col("h"))).collect()]
    assert got == [("T & U", "Head Body text ."), ("", "")]


def body_of(spark, *pages):
    return one(spark, html_body(F.col("x")), [(p,) for p in pages])


def test_nested_boilerplate_leaves_no_text(spark):
    nested_nav = "<body><nav>a<nav>b</nav>c</nav><p>Text one.</p><NAV>d</NAV></body>"
    nested_ad = ("<body><article><p>First.</p><div class=\"box ad-slot\"><div>Buy<div>now</div></div>today</div> between "
                 "<p>Second.</p></article></body>")
    aside = "<body><article><aside><p>Also read <b>this</b></p><aside>x</aside></aside><p>Story.</p></article><footer>Imprint</footer></body>"
    footer = "<body><div id='sidebar'><div><ul><li>z</li></ul></div></div><main><p>Main text</p></main><footer><p>(c)</p></footer></body>"
    assert body_of(spark, nested_nav, nested_ad, aside, footer) == ["Text one.", "First. between Second.", "Story.", "Main text"]


def test_words_inside_names_are_no_boilerplate(spark):
    assert body_of(spark, '<body><div class="header gradient"><p>Shadow</p></div><p class=adagio>Music</p></body>') == ["Shadow Music"]


def test_blocks_of_links_go_and_texts_with_links_stay(spark):
    page = ('<body><p>A long enough sentence with <a href="/x">one link</a> and <a href="/y">another</a> in its text.</p>'
            '<ul><li><a href="/1">Home</a></li><li><a href="/2">News</a></li></ul><h2><a href="/3">Headline</a></h2></body>')
    assert body_of(spark, page) == ["A long enough sentence with one link and another in its text. Headline"]


def test_raw_elements_unclosed_elements_and_empty_pages(spark):
    assert body_of(spark, "<body><script>if (a < b) '<nav>'</script><p>Kept</p><div class='ad'>never closed <p>More",
                   "plain words", "", None, "<!-- <nav> --><p>x</p>", "<p>cut <a href=") == [
        "Kept never closed More", "plain words", "", None, "x", "cut <a href="]


def test_long_page_with_many_blocks(spark):
    page = "<body>" + "<div class='ad'><div>x</div></div><p>word</p>" * 3000 + "</body>"
    assert body_of(spark, page) == [" ".join(["word"] * 3000)]
