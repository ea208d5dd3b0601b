"""Text scalar functions.

All are compositions of built-in expressions (regexp_*, transform, slice),
so they stay inside whole-stage codegen; no per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# word tokens keep the whitespace that precedes them, so joining a slice of
# tokens reproduces the original text span (later chunks keep a leading space)
TOKEN_PATTERN = r"(\s*\S+)"
HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)"
HOST_PREFIX_PATTERN = r"^(www|m|blog)\."


def provider_domain(url: Column) -> Column:
    """Host of the URL, lower-cased, without a www./m./blog. prefix."""
    host = F.lower(F.regexp_extract(url, HOST_PATTERN, 1))
    return F.regexp_replace(host, HOST_PREFIX_PATTERN, "")


def _unescape(c: Column) -> Column:
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "),
                    ("&amp;", "&")):
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def _squash(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def html_title(html: Column) -> Column:
    """Text of the <title> element."""
    return _squash(_unescape(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)))


# elements that hold no article text; the words are chosen, in class, id or role of any element
BOILERPLATE = ("nav", "aside", "footer", "form", "menu", "dialog", "figcaption")
BOILERPLATE_WORDS = ("ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comments", "cookie", "menu",
                     "nav", "navigation", "newsletter", "promo", "related", "share", "sidebar", "social", "sponsored")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
# tags at which a block of text ends; the items of a list are one block
BLOCK_TAGS = (r"(?i)</?(?:address|article|aside|blockquote|body|dd|div|dl|dt|fieldset|figure|h[1-6]|header|hr|main|ol|p|pre|section|"
              r"table|td|th|tr|ul)(?![A-Za-z0-9-])[^>]*>")


def _bound(value: Column, f) -> Column:
    """f(value), with the value computed once however often f names it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _tag(piece: Column) -> Column:
    """What a piece (a tag and the text up to the next one) does to the nesting."""
    words = "|".join(BOILERPLATE_WORDS)
    named = piece.rlike(rf"(?i)^<[^>]*\s(?:class|id|role)\s*=\s*(?:\"(?:[^\"]*[\s_-])?(?:{words})(?:[\s_-][^\"]*)?\""
                        rf"|'(?:[^']*[\s_-])?(?:{words})(?:[\s_-][^']*)?'|(?:{words})(?=[\s>]))")

    def nesting(name: Column) -> Column:
        closes = piece.startswith("</")
        opens = (name != "") & ~closes & ~name.isin(*VOID) & ~piece.rlike("^<[^>]*/>")
        return _bound(opens, lambda o: F.struct(
            name.alias("name"), o.alias("opens"), closes.alias("closes"),
            (o & ~name.isin("html", "body", "main", "article") & (name.isin(*BOILERPLATE) | named)).alias("drops")))

    return _bound(F.lower(F.regexp_extract(piece, r"^</?([A-Za-z][A-Za-z0-9-]*)", 1)), nesting)


def _without_boilerplate(html: Column) -> Column:
    """The markup without boilerplate elements and all that is nested in them.

    One pass over the tags keeps the outermost open boilerplate element and how
    deep elements of its name are nested in it, and notes where it begins and
    ends. An element that is never closed drops nothing.
    """
    span = "struct<name:string,depth:int,start:int,at:int,gone:array<struct<start:int,end:int>>>"
    none = F.lit(None).cast("string")

    def step(s: Column, t: Column) -> Column:
        inside = s["name"].isNotNull()
        change = F.when(~inside, F.when(t["drops"], 1).otherwise(0)).when(t["name"] != s["name"], 0).when(t["closes"], -1).when(t["opens"], 1).otherwise(0)
        depth = s["depth"] + change
        ends = inside & (depth == 0)
        return F.struct(F.when(ends, none).when(inside, s["name"]).when(t["drops"], t["name"]).otherwise(none).alias("name"), depth.alias("depth"),
                        F.when(inside, s["start"]).otherwise(s["at"]).alias("start"), (s["at"] + 1).alias("at"),
                        F.when(ends, F.array_append(s["gone"], F.struct(s["start"].alias("start"), s["at"].alias("end"))))
                        .otherwise(s["gone"]).alias("gone")).cast(span)

    def kept(pieces: Column) -> Column:
        first = F.struct(none, F.lit(0), F.lit(0), F.lit(0), F.array().cast("array<struct<start:int,end:int>>")).cast(span)
        gone = F.aggregate(F.transform(pieces, _tag), first, step, lambda s: s["gone"])
        return _bound(gone, lambda g: F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(g)), lambda k: _between(pieces, g, k))), ""))

    def _between(pieces: Column, g: Column, k: Column) -> Column:
        """What stands between the (k-1)-th and the k-th element; an element leaves the text behind its last tag."""
        last = F.get(g, k - 1)["end"]
        start, end = F.coalesce(last + 1, F.lit(0)), F.coalesce(F.get(g, k)["start"], F.size(pieces))
        behind = F.coalesce(F.regexp_replace(F.get(pieces, last), "^<[^>]*>", " "), F.lit(""))
        return F.concat(F.array(behind), F.slice(pieces, start + 1, F.greatest(end - start, F.lit(0))))

    return _bound(F.regexp_extract_all(html, F.lit(r"<[^>]*>[^<]*|^[^<]+|<[^<>]*$"), 0), kept)


def _text_blocks(markup: Column) -> Column:
    """The blocks of the markup that are text: those with several links that hold more than half of its characters go."""
    def chars(c: Column) -> Column:
        return F.length(F.regexp_replace(c, r"<[^>]*>|\s+", ""))

    def linked(block: Column) -> Column:
        links = F.regexp_extract_all(block, F.lit(r"(?is)<a(?![A-Za-z0-9-])[^>]*>(.*?)</a>"), 1)
        return _bound(links, lambda x: (F.size(x) > 1) & (chars(F.array_join(x, "")) * 2 > chars(block)))

    return F.array_join(F.filter(F.split(markup, BLOCK_TAGS), lambda b: ~linked(b)), " ")


def html_body(html: Column) -> Column:
    """Visible article text.

    Comments and raw elements (script, style, ..) go first. Boilerplate elements
    (``BOILERPLATE``, or named so by class, id or role) go with all that is
    nested in them. Of the rest the <article> element is taken when there is
    one (else <body>), split into blocks, and blocks made of links are left
    out. Common entities are un-escaped. Empty result means "no body" (F3).
    """
    c = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    c = F.regexp_replace(c, r"(?is)<(script|style|noscript|template|svg|title)(?![A-Za-z0-9-])[^>]*>.*?</\1\s*>", " ")

    def region(c: Column) -> Column:
        article = F.regexp_extract(c, r"(?is)<article(?![A-Za-z0-9-])[^>]*>(.*)</article>", 1)
        body = F.regexp_extract(c, r"(?is)<body(?![A-Za-z0-9-])[^>]*>(.*)</body>", 1)
        return F.when(F.length(article) > 0, article).when(F.length(body) > 0, body).otherwise(c)

    text = _text_blocks(_bound(_without_boilerplate(c), region))
    return _squash(_unescape(F.regexp_replace(text, r"<[^>]*>", " ")))


def strip_wrapping_quotes(s: Column) -> Column:
    """Drop the wrapping quotes when both ends carry one (a lone quote -> '')."""
    return F.when(s.startswith('"') & s.endswith('"'),
                  F.substring(s, F.lit(2), F.length(s) - 2)).otherwise(s)


def json_payload(*cols: str | Column) -> Column:
    """The original record kept as a JSON string."""
    return F.to_json(F.struct(*cols))


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 1)


def token_chunks(text: Column, size: int, overlap: int = 0) -> Column:
    """Array of chunks of ``size`` word tokens, step ``size - overlap``."""
    if size <= overlap:
        raise ValueError("chunk size must exceed overlap")
    step = size - overlap

    def chunks(toks: Column) -> Column:
        n = F.size(toks)
        starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda s: F.array_join(F.slice(toks, s + 1, F.lit(size)), ""))

    # bound to a lambda variable, the tokens are computed once, not once per chunk
    return F.element_at(F.transform(F.array(word_tokens(text)), chunks), 1)


def token_count(text: Column) -> Column:
    return F.size(word_tokens(text))


EMBEDDING_MODES = (
    "title", "description", "content",
    "title_and_description_concat", "title_and_content_concat",
    "description_and_content_concat", "title_and_description_and_content_concat",
    "title_and_description_avg", "title_and_content_avg",
    "description_and_content_avg", "title_and_description_and_content_avg",
)


def embedding_docs(mode: str, title: Column, description: Column, content: Column) -> Column:
    """The array of documents embedded for one article.

    Single and concat modes give one document, avg modes give one document
    per attribute (their vectors are averaged later by A11). Newlines become
    spaces.
    """
    parts = {"title": title, "description": description, "content": content}
    if mode not in EMBEDDING_MODES:
        raise NotImplementedError(f"embedding mode {mode}")
    names = mode.replace("_concat", "").replace("_avg", "").split("_and_")
    cols = [F.coalesce(parts[n], F.lit("")) for n in names]
    if mode.endswith("_avg"):
        docs = F.array(*cols)
    else:
        docs = F.array(F.concat_ws(" ", *cols))
    return F.transform(docs, lambda d: F.replace(d, F.lit("\n"), F.lit(" ")))
