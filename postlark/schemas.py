"""Declared schemas of the JSON and Parquet inputs.

Readers always pass one of these: inference would cost a full extra scan, and it
drops optional fields (``entities``, ``context_annotations``, ``data`` of an empty
page) that happen to be absent from the files at hand. All are DDL strings, as readers and
``from_json`` take them.
"""

PUBLIC_METRICS = (
    "STRUCT<like_count: BIGINT, quote_count: BIGINT, reply_count: BIGINT, retweet_count: BIGINT>"
)
TOPIC_PART = "STRUCT<id: STRING, name: STRING, description: STRING>"
ANNOTATIONS = f"ARRAY<STRUCT<domain: {TOPIC_PART}, entity: {TOPIC_PART}>>"
ENTITIES = (
    "STRUCT<hashtags: ARRAY<STRUCT<tag: STRING>>, "
    "mentions: ARRAY<STRUCT<id: STRING, username: STRING>>, "
    "cashtags: ARRAY<STRUCT<tag: STRING>>, "
    "urls: ARRAY<STRUCT<url: STRING, expanded_url: STRING, display_url: STRING>>>"
)
# Fields that posts carry and no query reads. What is in them beyond this stays in the line.
UNUSED_FIELDS = (
    "conversation_id: STRING, in_reply_to_user_id: STRING, possibly_sensitive: BOOLEAN, "
    "geo: STRUCT<place_id: STRING>, attachments: STRUCT<media_keys: ARRAY<STRING>, "
    "poll_ids: ARRAY<STRING>>, withheld: STRUCT<copyright: BOOLEAN, country_codes: ARRAY<STRING>>"
)
POST = (
    "STRUCT<id: STRING, text: STRING, lang: STRING, author_id: STRING, created_at: STRING, "
    f"source: STRING, entities: {ENTITIES}, public_metrics: {PUBLIC_METRICS}, "
    "referenced_tweets: ARRAY<STRUCT<id: STRING, type: STRING>>, "
    f"context_annotations: {ANNOTATIONS}, {UNUSED_FIELDS}>"
)
PAGE_META = (
    "STRUCT<newest_id: STRING, oldest_id: STRING, result_count: BIGINT, next_token: STRING>"
)
PROFILE = (
    "STRUCT<id: STRING, name: STRING, username: STRING, public_metrics: STRUCT<"
    "followers_count: BIGINT, following_count: BIGINT, tweet_count: BIGINT, listed_count: BIGINT>>"
)

# One row per post, every field under the struct ``data``.
STREAM_POST = f"data {POST}"
# One row per search page: ``data`` is an array of posts.
SEARCH_PAGE = f"data ARRAY<{POST}>, meta {PAGE_META}"
# The part of a search page that the topic reports use. A scan cannot prune below an array in
# an array by itself, so this leaves ids and descriptions of the annotations unread.
TOPIC_PAGE = (
    f"data ARRAY<STRUCT<lang: STRING, public_metrics: {PUBLIC_METRICS}, "
    "context_annotations: ARRAY<STRUCT<domain: STRUCT<name: STRING>, "
    "entity: STRUCT<name: STRING>>>>>"
)
# The part of a page that the cursors use: the parser skips everything else.
CURSOR_PAGE = "data ARRAY<STRUCT<id: STRING>>, meta STRUCT<oldest_id: STRING>"
# A search page that carries the key it was requested with.
TIMELINE_PAGE = f"username STRING, {SEARCH_PAGE}"
# One row per profile lookup: ``data`` is an array of accounts.
PROFILE_PAGE = f"data ARRAY<{PROFILE}>"
# Lines that are not valid JSON go into this column when documents are parsed.
CORRUPT_RECORD = "_corrupt_record"
# The text that a row was parsed from: fields outside the schema stay here.
LINE = "_line"


def keeping_corrupt(schema: str) -> str:
    """The schema with the column for lines that are not valid JSON."""
    return f"{schema}, {CORRUPT_RECORD} STRING"
