"""Prompt rendering for the summarising functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K

STUFF_SEPARATOR = "\n\n"


def _with_topic(template: str, topic: Column) -> Column:
    return F.replace(F.lit(template), F.lit("####topic####"), topic)


def title_prompt(topic: Column, titles_joined: Column) -> Column:
    return F.replace(_with_topic(K.TITLE_TEMPLATE, topic), F.lit("{text}"), titles_joined)


def summary_prompt(topic: Column, length: str, full_text: Column) -> Column:
    definition = {"medium": K.MEDIUM_SUMMARY_DEFINITION, "short": K.SHORT_SUMMARY_DEFINITION}[length]
    t = F.replace(_with_topic(K.SUMMARY_TEMPLATE, topic), F.lit("####summary_definition####"),
                  F.lit(definition))
    return F.replace(t, F.lit("{text}"), full_text)


def rewrite_prompt(topic: Column, text: Column) -> Column:
    return F.replace(_with_topic(K.REWRITE_TEMPLATE, topic), F.lit("{text}"), text)


def refine_prompt(topic: Column, text: Column, existing_answer: Column) -> Column:
    # {text} first: the existing answer is model output and may contain "{text}"
    t = F.replace(_with_topic(K.REFINE_TEMPLATE, topic), F.lit("{text}"), text)
    return F.replace(t, F.lit("{existing_answer}"), existing_answer)


def refine_step_prompt(pos: Column, topic: Column, text: Column, existing_answer: Column) -> Column:
    """Step 0 rewrites the first document, later steps refine."""
    return F.when(pos == 0, rewrite_prompt(topic, text)).otherwise(
        refine_prompt(topic, text, existing_answer))
