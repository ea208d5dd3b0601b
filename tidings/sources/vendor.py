"""Landed vendor responses: schemas, flattening (S1-S3), error envelopes
(S4) and required-field checks (S5).

Responses are JSON lines, one envelope per line, read with an explicit
schema (no inference). Fields that nest without end or drift
(``clusteredArticles``, ``relatedTopics``) are VARIANT columns.

Every line that is read goes one of two ways: data, or quarantine with a code
and a message (error envelopes, lines that are no JSON of the schema, envelopes
without a required field).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import BING, NEWSAPI_ORG, THENEWSAPI_COM
from ..functions.categories import category_map, category_multi
from ..functions.text import provider_domain

S, B, L, D = T.StringType(), T.BooleanType(), T.LongType(), T.DoubleType()


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


NAME_ONLY = _st(("name", S))
THUMB = _st(("contentUrl", S), ("height", L), ("width", L))
BING_ARTICLE = _st(
    ("category", S), ("clusteredArticles", T.VariantType()), ("datePublished", S), ("description", S), ("headline", B),
    ("id", S), ("image", _st(("thumbnail", THUMB))), ("mentions", T.ArrayType(NAME_ONLY)), ("name", S),
    ("provider", T.ArrayType(NAME_ONLY)), ("url", S),
    ("video", _st(("name", S), ("thumbnailUrl", S), ("motionThumbnailUrl", S))))
BING_ENVELOPE = _st(
    ("envelope_id", S), ("_type", S), ("queryContext", _st(("originalQuery", S), ("adultIntent", B), ("alteredQuery", S),
                                                                     ("alterationOverrideQuery", S))),
    ("relatedTopics", T.VariantType()), ("content", S),
    ("totalEstimatedMatches", L),
    ("sort", T.ArrayType(_st(("name", S), ("id", S), ("isSelected", B), ("url", S)))),
    ("value", T.ArrayType(BING_ARTICLE)),
    ("errors", T.ArrayType(_st(("code", S), ("subCode", S), ("message", S), ("moreDetails", S),
                               ("parameter", S), ("value", S)))))
NEWSAPI_ARTICLE = _st(("source", _st(("id", S), ("name", S))), ("author", S), ("title", S), ("description", S),
                      ("url", S), ("urlToImage", S), ("publishedAt", S), ("content", S))
NEWSAPI_ENVELOPE = _st(("envelope_id", S), ("status", S), ("code", S), ("message", S), ("totalResults", L),
                       ("articles", T.ArrayType(NEWSAPI_ARTICLE)))
THENEWSAPI_ARTICLE = _st(("uuid", S), ("title", S), ("description", S), ("keywords", S), ("snippet", S), ("url", S),
                         ("image_url", S), ("language", S), ("published_at", S), ("source", S),
                         ("categories", T.ArrayType(S)), ("relevance_score", D), ("locale", S))
THENEWSAPI_ENVELOPE = _st(("envelope_id", S), ("meta", _st(("found", L), ("returned", L), ("limit", L), ("page", L))),
                          ("data", T.ArrayType(THENEWSAPI_ARTICLE)),
                          ("error", _st(("code", S), ("message", S))))
ENVELOPES = {BING: BING_ENVELOPE, NEWSAPI_ORG: NEWSAPI_ENVELOPE, THENEWSAPI_COM: THENEWSAPI_ENVELOPE}

# non-Optional article fields per vendor (a row missing one is rejected)
REQUIRED = {
    BING: ("description", "name", "provider", "url"),
    NEWSAPI_ORG: ("source", "title", "description", "url", "publishedAt"),
    THENEWSAPI_COM: ("uuid", "title", "description", "keywords", "snippet", "url", "image_url", "language",
                     "published_at", "source", "categories"),
}


# non-Optional fields of an envelope that is no error
REQUIRED_ENVELOPE = {BING: ("value",), NEWSAPI_ORG: ("status", "totalResults", "articles"), THENEWSAPI_COM: ("meta", "data")}
CORRUPT = "_corrupt_record"


def read_envelopes(spark: SparkSession, path: str, vendor: str) -> DataFrame:
    """One row per line with anything on it; a line that is not JSON of the
    schema stands in ``_corrupt_record`` as it is.

    Lines are read as text, so that whether a line is corrupt does not depend
    on the columns a query reads.
    """
    schema = T.StructType([*ENVELOPES[vendor].fields, T.StructField(CORRUPT, S)])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # the text "null" is an object without fields to the parser, and no corrupt line
    corrupt = F.coalesce(F.col(f"_e.{CORRUPT}"), F.when(F.trim("value") == "null", F.col("value")))
    return lines.select("value", parsed.alias("_e")).select("_e.*", corrupt.alias("_line")).drop(CORRUPT).withColumnRenamed("_line", CORRUPT)


def is_error(vendor: str) -> Column:
    """Whether a readable envelope reports an error; never null."""
    if vendor == BING:
        return (F.coalesce(F.size("errors"), F.lit(0)) > 0) | (F.col("_type").eqNullSafe("ErrorResponse"))
    if vendor == NEWSAPI_ORG:
        return F.col("status").eqNullSafe("error")
    return F.col("error").isNotNull()


def missing_envelope_fields(vendor: str) -> Column:
    """Comma list of the required envelope fields that are null."""
    return F.array_join(F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in REQUIRED_ENVELOPE[vendor]])), ",")


def split_errors(env: DataFrame, vendor: str) -> tuple[DataFrame, DataFrame]:
    """(data envelopes, quarantine). Every row of ``env`` is in one of the two: quarantined are unreadable
    lines (``malformed_json``, the line as message), error envelopes (the vendor's code and message) and envelopes
    without a required field (``missing_fields``, their names as message)."""
    if vendor == BING:
        first = F.try_element_at(F.col("errors"), F.lit(1))   # null, not an error, when empty
        code, msg = first["code"], first["message"]
    elif vendor == NEWSAPI_ORG:
        code, msg = F.col("code"), F.col("message")
    else:
        code, msg = F.col("error.code"), F.col("error.message")
    broken, err, missing = F.col(CORRUPT).isNotNull(), is_error(vendor), missing_envelope_fields(vendor)
    why = F.when(broken, F.lit("malformed_json")).when(err, F.lit("error")).when(missing != "", F.lit("missing_fields"))
    split = env.withColumn("_why", why)
    quarantine = split.filter("_why IS NOT NULL").select(
        "envelope_id", F.lit(vendor).alias("vendor"), F.when(F.col("_why") == "error", code).otherwise(F.col("_why")).alias("error_code"),
        F.when(broken, F.col(CORRUPT)).when(err, msg).otherwise(missing).alias("error_message"))
    return split.filter("_why IS NULL").drop("_why"), quarantine


def unanswered(data: DataFrame, quarantine: DataFrame) -> DataFrame:
    """(envelope_id, error) of the requests that got no data: an error
    envelope, or one without its fields, that no data envelope stands beside."""
    failed = quarantine.filter("envelope_id IS NOT NULL").groupBy("envelope_id").agg(
        F.min(F.concat_ws(": ", "error_code", "error_message")).alias("error"))
    return failed.join(data.select("envelope_id"), "envelope_id", "left_anti")


def _articles(env: DataFrame, vendor: str) -> DataFrame:
    arr, total = {BING: ("value", "totalEstimatedMatches"), NEWSAPI_ORG: ("articles", "totalResults"),
                  THENEWSAPI_COM: ("data", "meta.found")}[vendor]
    context = ["queryContext"] if vendor == BING else []
    return env.select("envelope_id", F.col(total).alias("total_results"), *context, F.posexplode(arr).alias("pos", "a"))


def missing_fields(vendor: str) -> Column:
    """Comma list of required fields that are null (empty = valid)."""
    names = [F.when(F.col(f"a.{f}").isNull(), F.lit(f)) for f in REQUIRED[vendor]]
    return F.array_join(F.array_compact(F.array(*names)), ",")


def flatten(env: DataFrame, vendor: str) -> DataFrame:
    """One row per article with snake_case columns (+ envelope, pos)."""
    a = _articles(env, vendor)
    names = lambda x: F.transform(x, lambda p: p["name"])
    if vendor == BING:
        cols = [F.col("a.name").alias("title"), F.col("a.url").alias("url"),
                F.col("a.description").alias("description"), F.col("a.datePublished").alias("date_published"),
                F.coalesce(F.col("a.category"), F.lit("")).alias("category"),
                F.try_element_at(F.col("a.provider"), F.lit(1))["name"].alias("provider_name"),
                names(F.col("a.provider")).alias("providers"), names(F.col("a.mentions")).alias("mentions"),
                F.col("a.headline").alias("headline"), F.col("a.id").alias("id"),
                F.col("a.image.thumbnail.contentUrl").alias("thumbnail_url"),
                F.col("a.image.thumbnail.height").alias("thumbnail_height"), F.col("a.image.thumbnail.width").alias("thumbnail_width"),
                F.col("a.video.name").alias("video_name"), F.col("a.video.thumbnailUrl").alias("video_thumbnail_url"),
                F.col("a.video.motionThumbnailUrl").alias("video_motion_thumbnail_url"),
                F.col("a.clusteredArticles").alias("clustered_articles"), F.col("queryContext.originalQuery").alias("original_query"),
                F.col("queryContext.alteredQuery").alias("altered_query"),
                F.col("queryContext.alterationOverrideQuery").alias("alteration_override_query")]
    elif vendor == NEWSAPI_ORG:
        cols = [F.col("a.title").alias("title"), F.col("a.url").alias("url"),
                F.col("a.description").alias("description"), F.col("a.publishedAt").alias("published_at"),
                F.col("a.source.id").alias("source_id"), F.col("a.source.name").alias("source_name"),
                F.coalesce(F.col("a.author"), F.lit("")).alias("author"),
                F.col("a.content").alias("content"), F.col("a.urlToImage").alias("url_to_image")]
    else:
        cols = [F.col("a.title").alias("title"), F.col("a.url").alias("url"),
                F.col("a.description").alias("description"), F.col("a.published_at").alias("published_at"),
                F.col("a.source").alias("source"), F.col("a.categories").alias("categories"),
                F.col("a.uuid").alias("uuid"), F.col("a.snippet").alias("snippet"), F.col("a.keywords").alias("keywords"),
                F.col("a.image_url").alias("image_url"), F.col("a.language").alias("language"),
                F.col("a.relevance_score").alias("relevance_score"), F.col("a.locale").alias("locale")]
    return a.select("envelope_id", "pos", "total_results", *cols, F.to_json("a").alias("article_data"),
                    missing_fields(vendor).alias("missing_fields"))


def _each(variant: Column) -> Column:
    """The items of a variant array, in order; none if it is something else."""
    return F.posexplode(F.coalesce(F.try_variant_get(variant, "$", "array<variant>"), F.array().cast("array<variant>")))


def _nested_article(a: Column) -> list[Column]:
    fields = (("title", "name"), ("url", "url"), ("description", "description"), ("date_published", "datePublished"), ("category", "category"))
    return [F.try_variant_get(a, f"$.{f}", "string").alias(c) for c, f in fields]


def related_articles(env: DataFrame) -> DataFrame:
    """The news of Bing's related topics, one row per article, from the
    variant column; fields of any other type come out as null."""
    t = env.select("envelope_id", _each(F.col("relatedTopics")).alias("topic_pos", "_t"))
    t = t.select("envelope_id", "topic_pos", F.try_variant_get("_t", "$.name", "string").alias("related_topic"),
                 F.try_variant_get("_t", "$.webSearchUrl", "string").alias("web_search_url"), F.try_variant_get("_t", "$.relatedNews", "variant").alias("_news"))
    return t.select("envelope_id", "topic_pos", "related_topic", "web_search_url", _each(F.col("_news")).alias("pos", "_a")).select(
        "envelope_id", "topic_pos", "related_topic", "web_search_url", "pos", *_nested_article(F.col("_a")))


def clustered_articles(flat: DataFrame) -> DataFrame:
    """The articles that stand inside Bing articles, however deep: one row
    each of the first level, with its own clustered articles as a variant."""
    c = flat.select("envelope_id", "pos", _each(F.col("clustered_articles")).alias("inner_pos", "_a"))
    return c.select("envelope_id", "pos", "inner_pos", *_nested_article(F.col("_a")),
                    F.try_variant_get("_a", "$.clusteredArticles", "variant").alias("clustered_articles"))


def valid_articles(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their missing fields)."""
    bad = F.length("missing_fields") > 0
    return flat.filter(~bad), flat.filter(bad)


def raw_articles(flat: DataFrame, vendor: str) -> DataFrame:
    """Valid flattened rows of any vendor as raw articles: title, url,
    description, snippet, author, category (mapped), raw_published,
    provider_domain and the original record as JSON."""
    none = F.lit(None).cast("string")
    aggregator = F.lit(vendor)
    if vendor == BING:
        author, snippet, published, category = none, none, F.col("date_published"), category_map(F.col("category"), aggregator)
    elif vendor == NEWSAPI_ORG:
        author, snippet, published, category = F.col("author"), F.col("content"), F.col("published_at"), none
    else:
        author, snippet, published = none, F.col("snippet"), F.col("published_at")
        category = category_multi(F.col("categories"), aggregator)
    return flat.select(
        "envelope_id", "pos", aggregator.alias("aggregator_id"), "title", "url", provider_domain(F.col("url")).alias("provider_domain"),
        F.col("description").alias("article_text_description"), snippet.alias("article_text_snippet"), author.alias("author"),
        category.alias("category"), F.coalesce(published, F.lit("")).alias("raw_published"), "article_data")
