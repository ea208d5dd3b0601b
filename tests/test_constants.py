"""Fixed values stated a second time, so that a wrong constant is seen (the
oracles take them from the same module)."""

from tidings import constants as K


def test_categories():
    assert K.BING_CATEGORIES["ScienceAndTechnology"] == "science-and-technology"
    assert K.BING_CATEGORIES["World_MiddleEast"] == "world_middleeast" and len(K.BING_CATEGORIES) == 14
    assert K.THENEWSAPI_COM_CATEGORIES["tech"] == K.THENEWSAPI_COM_CATEGORIES["science"] == "science-and-technology"
    assert K.NEWSAPI_ORG_CATEGORIES == {} and K.NO_CATEGORY == "n/a"


def test_limits():
    assert (K.PAGE_SIZE, K.FETCH_MULTIPLIER, K.MIN_INVENTORY_TO_SOURCE) == (100, 2, 6)
    assert K.DOMAIN_CAP == {"newsapi.org": 500, "thenewsapi.com": 50}
    assert (K.CHUNK_TOKENS, K.CHUNK_OVERLAP, K.ARTICLE_SEPARATOR) == (250, 0, "=" * 20)
    assert K.HORIZON_DAYS == {"bingnews": 1, "newsapi.org": 30, "thenewsapi.com": 30}
    assert (K.TITLE_MIN_WORDS, K.TITLE_MAX_WORDS, K.SHORT_MAX_SENTENCES, K.MEDIUM_MIN_WORDS, K.MEDIUM_MAX_WORDS) == (5, 20, 3, 300, 600)


def test_prompts_have_their_holes():
    for template in (K.TITLE_TEMPLATE, K.SUMMARY_TEMPLATE, K.REWRITE_TEMPLATE, K.REFINE_TEMPLATE):
        assert "####topic####" in template and "{text}" in template
    assert "####summary_definition####" in K.SUMMARY_TEMPLATE and "{existing_answer}" in K.REFINE_TEMPLATE


def test_tokens():
    import re
    from tidings.functions.text import TOKEN_PATTERN
    assert re.findall(TOKEN_PATTERN, " a  b\nc ") == [" a", "  b", "\nc"]
