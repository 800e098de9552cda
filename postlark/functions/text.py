"""Column builders for words, punctuation and word-list ratings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that the word-list rating ignores.
PUNCTUATION = ".|,;?+!"

ONE_SPACE = " "
SPACE_RUN = " +"


def words(text: Column, separator: str = SPACE_RUN) -> Column:
    """Split text on spaces, without the empty words at the end.

    Leading and inner empty words stay, an empty text is one empty word and a text of
    spaces only has no word. Only spaces separate: a newline is part of a word.
    """
    trimmed = F.rtrim(text)
    no_words = F.array().cast("array<string>")
    return F.when((trimmed == "") & (text != ""), no_words).otherwise(F.split(trimmed, separator))


def strip_punctuation(text: Column) -> Column:
    """Remove the ignored characters wherever they stand."""
    return F.regexp_replace(text, f"[{PUNCTUATION}]", "")


def content_word_count(text: Column) -> Column:
    """Number of words that hold neither ``@`` nor ``#``; NULL for a NULL text."""
    plain = F.filter(words(text), lambda word: ~(word.contains("@") | word.contains("#")))
    return F.array_size(plain)


def rating_words(text: Column) -> Column:
    """Lower-case words without punctuation, as the word lists spell them.

    Removing punctuation never creates or removes a space, so it runs once over the whole
    text. The empty words this leaves match no list.
    """
    return F.split(strip_punctuation(F.lower(text)), ONE_SPACE)


def _literal(word: str) -> str:
    escaped = word.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def word_list_rating(words_column: str, positive: Iterable[str], negative: Iterable[str]) -> Column:
    """Positive words minus negative words in an array of words.

    A word in both lists counts as positive. The lists become hash sets in the plan. They
    are written as SQL text, because thousands of literal columns take seconds to build.
    """
    positive = set(positive)
    listed = sorted(positive | set(negative))
    if not listed:
        return F.when(F.col(words_column).isNotNull(), F.lit(0))
    any_list = ", ".join(map(_literal, listed))
    good_list = ", ".join(map(_literal, sorted(positive)))
    is_good = f"word IN ({good_list})" if good_list else "false"
    return F.expr(
        f"aggregate(filter(`{words_column}`, word -> word IN ({any_list})), 0, "
        f"(total, word) -> total + if({is_good}, 1, -1))"
    )


def starts_with_any(word: Column, prefixes: Iterable[str], exact: Iterable[str] = ()) -> Column:
    """Case-sensitive test for any of the prefixes or exact words."""
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | word.startswith(prefix)
    exact = list(exact)
    return hit | word.isin(exact) if exact else hit
