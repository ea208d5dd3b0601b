"""Default extractive summariser used when no batch function is supplied
(U2), written with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import MEDIUM_MAX_WORDS, SHORT_MAX_SENTENCES, TITLE_MAX_WORDS
from .text import strip_wrapping_quotes

SENTENCE_PATTERN = r"[^.!?]+[.!?]*"


def lead_words(text: Column, n: int) -> Column:
    """The first n words: one match that stops there, however long the text."""
    return F.trim(F.regexp_extract(text, rf"(?:\s*\S++){{1,{n}}}", 0))


def lead_sentences(text: Column, n: int) -> Column:
    return F.trim(F.regexp_extract(text, rf"(?:{SENTENCE_PATTERN}){{1,{n}}}", 0))


def default_title(first_title: Column) -> Column:
    return strip_wrapping_quotes(lead_words(first_title, TITLE_MAX_WORDS))


def default_full(texts_joined: Column) -> Column:
    return texts_joined


def default_medium(full: Column) -> Column:
    return F.when(F.length(full) > 0, lead_words(full, MEDIUM_MAX_WORDS))


def default_short(full: Column) -> Column:
    return F.when(F.length(full) > 0, lead_sentences(full, SHORT_MAX_SENTENCES))
