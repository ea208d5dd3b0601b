"""Constants of the article engine.

FIXED VALUES: everything in the block below must equal the values the
original service uses, or results differ (aggregator ids, date patterns,
category maps, prompt texts, limits). They are stated as plain text in their
natural order.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------- fixed values
BING = "bingnews"
NEWSAPI_ORG = "newsapi.org"
THENEWSAPI_COM = "thenewsapi.com"
AGGREGATORS = (BING, NEWSAPI_ORG, THENEWSAPI_COM)

DATE_SORTING = "date"
RELEVANCE_SORTING = "relevance"

OLDEST_SUPPORTED_PUBLISHING_DATE = _dt.datetime(2023, 1, 1, tzinfo=_dt.timezone.utc)

# published-date patterns per aggregator (the "." is deliberately unescaped)
BING_PUBLISHED_DATE_REGEX = r"^([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}.[0-9]{7}Z)$"
NEWSAPI_ORG_PUBLISHED_DATE_REGEX = r"^([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z)$"
THENEWSAPI_COM_PUBLISHED_DATE_REGEX = r"^([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}.[0-9]{6}Z)$"

BING_CATEGORIES = {
    "Business": "business",
    "Entertainment": "entertainment",
    "Health": "health",
    "Politics": "politics",
    "Products": "products",
    "ScienceAndTechnology": "science-and-technology",
    "Sports": "sports",
    "US": "us",
    "World": "world",
    "World_Africa": "world_africa",
    "World_Americas": "world_americas",
    "World_Asia": "world_asia",
    "World_Europe": "world_europe",
    "World_MiddleEast": "world_middleeast",
}
NEWSAPI_ORG_CATEGORIES: dict[str, str] = {}
THENEWSAPI_COM_CATEGORIES = {
    "business": "business",
    "entertainment": "entertainment",
    "health": "health",
    "politics": "politics",
    "science": "science-and-technology",
    "tech": "science-and-technology",
    "sports": "sports",
}
NO_CATEGORY = "n/a"

# Bing freshness words by whole-day window length
BING_FRESHNESS = {1: "Day", 7: "Week", 30: "Month"}

PAGE_SIZE = 100
FETCH_MULTIPLIER = 2
DAILY_SOURCING_FREQUENCY = 1.0
MIN_INVENTORY_TO_SOURCE = 6
DOMAIN_CAP = {NEWSAPI_ORG: 500, THENEWSAPI_COM: 50}
# historical horizon per aggregator, in days before today
HORIZON_DAYS = {BING: 1, NEWSAPI_ORG: 30, THENEWSAPI_COM: 30}

CHUNK_TOKENS = 250
CHUNK_OVERLAP = 0
ARTICLE_SEPARATOR = "===================="
EMBEDDING_USD_PER_TOKEN = 0.0001 / 1000

TITLE_MIN_WORDS, TITLE_MAX_WORDS = 5, 20
SHORT_MAX_SENTENCES = 3
MEDIUM_MIN_WORDS, MEDIUM_MAX_WORDS = 300, 600

MEDIUM_SUMMARY_DEFINITION = "The summary should be a medium length summary. A medium length summary is between 300-600 words."
SHORT_SUMMARY_DEFINITION = "The summary should be a short length summary. A short length summary should be at most 3 sentences."
NEWS_REPORTER_INTRO = "You are a world class news reporter, who is known for writing unbiased, informative, and entertaining articles in the ####topic#### space. Don't mention who you are in your articles."
REWRITE_TEMPLATE = NEWS_REPORTER_INTRO + """
    Your task is to rewrite a news article to ensure that it is unbiased and objective.
    Write the news article in a few paragraphs, if needed, where each paragraph represents a different key point in the news article.

    "{text}"

    REWRITE:"""
REFINE_TEMPLATE = NEWS_REPORTER_INTRO + """
    Your task is to produce a final rewritten news article to ensure that it is unbiased and objective.
    We have provided an existing rewritten article: {existing_answer}
    We have the opportunity to refine the existing rewritten news article (only if needed) with some more context from other news articles covering the same topic below.

    "{text}"
    
    Given the new context, refine the original rewritten news article.
    If the context isn't useful, return the original rewritten news article.
    Write the news article in a few paragraphs, if needed, where each paragraph represents a different key point in the news article.
    REWRITE:"""
TITLE_TEMPLATE = NEWS_REPORTER_INTRO + """
    Your task is to write an attention grabbing title for a news article based on existing titles for articles covering the same topic that you can use as reference in helping you write this new title.
    The title should be between 5-20 words.

    "{text}"

    TITLE:"""
SUMMARY_TEMPLATE = NEWS_REPORTER_INTRO + """
    Your task is to create a summary for a news article to ensure that it is unbiased and objective.
    Write the news article in a few paragraphs, if needed, where each paragraph represents a different key point in the news article.
    ####summary_definition####

    "{text}"

    SUMMARY:"""
# ------------------------------------------------------------ end fixed values

PUBLISHED_DATE_REGEX = {
    BING: BING_PUBLISHED_DATE_REGEX,
    NEWSAPI_ORG: NEWSAPI_ORG_PUBLISHED_DATE_REGEX,
    THENEWSAPI_COM: THENEWSAPI_COM_PUBLISHED_DATE_REGEX,
}
# Spark datetime patterns that read the three vendor forms
PUBLISHED_DATE_FORMAT = {
    BING: "yyyy-MM-dd'T'HH:mm:ss.SSSSSSS'Z'",
    NEWSAPI_ORG: "yyyy-MM-dd'T'HH:mm:ss'Z'",
    THENEWSAPI_COM: "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
}
CATEGORY_MAPS = {
    BING: BING_CATEGORIES,
    NEWSAPI_ORG: NEWSAPI_ORG_CATEGORIES,
    THENEWSAPI_COM: THENEWSAPI_COM_CATEGORIES,
}
# aggregators whose accepted rows must carry a description and a trusted domain
NEEDS_TRUST = {BING: False, NEWSAPI_ORG: True, THENEWSAPI_COM: True}
