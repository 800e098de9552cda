"""The word functions as functions of SQL: scalar ones, and table functions for use behind LATERAL.

They are written in SQL, so Catalyst puts their bodies into the query that calls them: a plan with
them is the plan without them, and no text leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from postlark.functions.text import PUNCTUATION

_NO_WORDS = "rtrim(text) = '' AND text <> ''"


def _words(separator: str) -> str:
    return f"IF({_NO_WORDS}, CAST(array() AS ARRAY<STRING>), split(rtrim(text), '{separator}'))"


# Name, parameters, result, body, and what it does.
FUNCTIONS = (
    (
        "post_words", "text STRING", "ARRAY<STRING>", _words(" +"),
        "words between runs of spaces, without empty ones at the end",
    ),
    (
        "content_words", "text STRING", "INT",
        "size(filter(post_words(text), w -> NOT contains(w, '@') AND NOT contains(w, '#')))",
        "number of words with neither @ nor #",
    ),
    (
        "rating_words", "text STRING", "ARRAY<STRING>",
        f"split(translate(lower(text), '{PUNCTUATION}', ''), ' ')",
        "lower-case words without punctuation",
    ),
    (
        "list_rating", "words ARRAY<STRING>, positive ARRAY<STRING>, negative ARRAY<STRING>", "INT",
        "aggregate(words, 0, (total, w) -> total + CASE WHEN array_contains(positive, w) THEN 1 "
        "WHEN array_contains(negative, w) THEN -1 ELSE 0 END)",
        "positive minus negative words; a word in both lists is positive",
    ),
    (
        "words_of", "text STRING", "TABLE (word STRING)",
        f"SELECT explode({_words(' ')}) AS word",
        "one row a word between single spaces",
    ),
    (
        "tags_of", "tags ARRAY<STRING>", "TABLE (tag STRING)",
        "SELECT explode(tags) AS tag",
        "one row a tag",
    ),
)


def register(spark: SparkSession) -> list[str]:
    """Create the functions for this session, in place of earlier ones, and return their names."""
    for name, parameters, result, body, comment in FUNCTIONS:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} "
            f"COMMENT '{comment}' RETURN {body}"
        )
    return [name for name, *_ in FUNCTIONS]
