"""Hashtag frequency, text length, sentiment, co-use and tags of popular accounts.

Inputs are posts in the stream shape: one row per post, fields under ``data``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlark.functions.text import content_word_count, rating_words, word_list_rating


def _tagged(posts: DataFrame, lang: str) -> DataFrame:
    return posts.filter((F.col("data.lang") == lang) & F.col("data.entities.hashtags").isNotNull())


def hashtag_base(posts: DataFrame, lang: str = "en") -> DataFrame:
    """``text`` and ``hashtag`` (array of strings) of the tagged posts in one language."""
    return _tagged(posts, lang).select(
        F.col("data.text").alias("text"), F.col("data.entities.hashtags.tag").alias("hashtag")
    )


def frequent_tags(base: DataFrame, min_count: int = 100) -> DataFrame:
    """``hashtag2``, ``count`` of the tags that occur more than ``min_count`` times."""
    return (
        base.select(F.explode("hashtag").alias("hashtag2"))
        .groupBy("hashtag2")
        .agg(F.count("*").alias("count"))
        .filter(F.col("count") > min_count)
    )


def avg_length_by_tag(base: DataFrame, min_count: int = 100) -> DataFrame:
    """``hashtag``, ``avgLength``: mean content words of the posts of each frequent tag.

    Count and mean come from one aggregate, so no join back to the frequent tags is needed.
    """
    lengths = base.select(content_word_count(F.col("text")).alias("length"), "hashtag")
    return (
        lengths.select("length", F.explode("hashtag").alias("hashtag"))
        .filter(F.col("hashtag").isNotNull())
        .groupBy("hashtag")
        .agg(F.count("*").alias("uses"), F.avg("length").alias("mean"))
        .filter(F.col("uses") > min_count)
        .orderBy(F.desc("mean"), "hashtag")
        .select("hashtag", F.round("mean", 2).alias("avgLength"))
    )


def rate_text(base: DataFrame, lexicon: DataFrame | dict[str, int]) -> DataFrame:
    """Add ``rating``: positive minus negative words of ``text``, NULL for a NULL text.

    ``lexicon`` is a word-to-polarity dictionary, which becomes hash sets inside the plan and
    needs no shuffle, or a DataFrame (``word``, ``polarity``) of any length, which is joined.
    Both rate alike: a word counts by the sign of its polarity, and one that is listed as both
    is positive.
    """
    if isinstance(lexicon, DataFrame):
        return _rate_text_by_join(base, lexicon)
    positive = [word for word, polarity in lexicon.items() if polarity > 0]
    negative = [word for word, polarity in lexicon.items() if polarity < 0]
    rating = word_list_rating("_words", positive, negative)
    listed = base.withColumn("_words", rating_words(F.col("text")))
    return listed.withColumn("rating", rating).drop("_words")


def _rate_text_by_join(base: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Ratings through a join of the words with the list.

    Equal texts have equal ratings, so each text digest is rated once: its words meet the list
    and are summed per digest, which is unique when it returns to the rows. Both joins carry no
    hint: a list that is small enough is broadcast and the words stay where they are, and
    adaptive execution splits a word or a text that is hot in a longer one. Rows without a text
    have digests of their own, so that they do not meet in one task.
    """
    signs = (
        lexicon.filter("word IS NOT NULL AND polarity <> 0")
        .groupBy("word")
        .agg(F.max(F.signum("polarity").cast("int")).alias("_sign"))
    )
    others = [F.col(f"`{name}`") for name in base.columns]
    none = F.concat(F.lit("-"), F.xxhash64(*others).cast("string"))
    keyed = base.withColumn("_digest", F.coalesce(F.sha2("text", 256), none))
    rated = (
        base.filter(F.col("text").isNotNull())
        .groupBy(F.sha2("text", 256).alias("_digest"))
        .agg(F.any_value("text").alias("text"))
        .select("_digest", F.explode(rating_words(F.col("text"))).alias("word"))
        .join(signs, "word")
        .groupBy("_digest")
        .agg(F.sum("_sign").alias("_sum"))
    )
    found = keyed.join(rated, "_digest", "left")
    rating = F.when(F.col("text").isNotNull(), F.coalesce("_sum", F.lit(0))).cast("int")
    return found.withColumn("rating", rating).drop("_digest", "_sum")


def mean_ratings(base: DataFrame, lexicon: DataFrame | dict[str, int]) -> DataFrame:
    """``hashtag``, ``mean``: the mean rating of the posts of each tag."""
    rated = rate_text(base, lexicon)
    return (
        rated.select("rating", F.explode("hashtag").alias("hashtag"))
        .groupBy("hashtag")
        .agg(F.avg("rating").alias("mean"))
    )


def ranked_ratings(means: DataFrame, descending: bool = True) -> DataFrame:
    """``hashtag``, ``rating``: mean ratings rounded, best or worst first."""
    mean = F.col("mean")
    return means.orderBy(mean.desc() if descending else mean.asc(), "hashtag").select(
        "hashtag", F.round("mean", 2).alias("rating")
    )


def tag_sentiment(
    base: DataFrame, lexicon: DataFrame | dict[str, int], descending: bool = True
) -> DataFrame:
    """``hashtag``, ``rating``: mean rating of the posts of each tag, best or worst first."""
    return ranked_ratings(mean_ratings(base, lexicon), descending)


def multi_tag_counts(posts: DataFrame, lang: str = "en") -> DataFrame:
    """``tags``, ``count`` over post ids that carry at least two tag rows.

    One tag written twice qualifies, and the rows of a repeated id add up. An id fails only
    if it has exactly one tag row in all, so the result is every tag row minus those single
    rows. Per id only a sum and one tag are shuffled, never the list of its tags, so a hot
    id folds into one row on the map side.
    """
    tagged = (
        _tagged(posts, lang)
        .select(F.col("data.id").alias("id"), F.col("data.entities.hashtags.tag").alias("tags"))
        .filter(F.col("id").isNotNull())
    )
    every = tagged.select(F.explode("tags").alias("tags"), F.lit(1).alias("step"))
    only_tag = F.when(F.size("tags") == 1, F.get("tags", F.lit(0)))
    single = (
        tagged.select("id", F.size("tags").alias("rows"), only_tag.alias("tags"))
        .groupBy("id")
        .agg(F.sum("rows").alias("rows"), F.min("tags").alias("tags"))
        .filter(F.col("rows") == 1)
        .select("tags", F.lit(-1).alias("step"))
    )
    return (
        every.union(single)
        .groupBy("tags")
        .agg(F.sum("step").alias("count"))
        .filter(F.col("count") > 0)
        .orderBy(F.desc("count"), "tags")
    )


def leading_posts(posts: DataFrame, lang: str = "en", top_n: int = 200) -> DataFrame:
    """``author_id``, ``likes``, ``id`` of the most liked posts in one language, ties by id."""
    return ranked_posts(
        posts.filter(F.col("data.lang") == lang).select(
            F.col("data.author_id").alias("author_id"),
            F.col("data.public_metrics.like_count").alias("likes"),
            F.col("data.id").alias("id"),
        ),
        top_n,
    )


def ranked_posts(posts: DataFrame, top_n: int) -> DataFrame:
    return posts.orderBy(F.desc("likes"), "id", "author_id").limit(top_n)


def popular_account_tags(
    posts: DataFrame,
    lang: str = "en",
    top_n: int = 200,
    distinct_authors: bool = False,
    leading: DataFrame | None = None,
) -> DataFrame:
    """``singleTags``, ``count`` of tags used by the authors of the most liked posts.

    An author with k posts among the ``top_n`` counts each of their tags k times, unless
    ``distinct_authors`` is set. The factor is carried as a number instead of repeated rows.
    ``leading`` may hold the leading posts, as a stream keeps them; otherwise they are found here.
    """
    leading = leading_posts(posts, lang, top_n) if leading is None else leading.limit(top_n)
    authors = leading.groupBy("author_id").agg(
        (F.lit(1) if distinct_authors else F.count("*")).alias("factor")
    )
    tagged = _tagged(posts, lang).select(
        F.col("data.author_id").alias("author_id"),
        F.col("data.entities.hashtags.tag").alias("hashtags"),
    )
    # At most ``top_n`` authors.
    by_popular = tagged.join(F.broadcast(authors), "author_id")
    uses: Column = F.sum("factor").alias("count")
    return (
        by_popular.select(F.explode("hashtags").alias("singleTags"), "factor")
        .groupBy("singleTags")
        .agg(uses)
        .orderBy(F.desc("count"), "singleTags")
    )
