"""The named queries in DuckDB SQL, for the correctness checks."""

from __future__ import annotations

from postlark.plans.queries import EVERY, MIN_TAG_COUNT
from postlark.plans.tables import DAYS, TAG_PATTERN, WORD_PATTERNS
from postlark.sources.lexicon import DEFAULT_LEXICON


def _round(value: str, digits: int) -> str:
    """Round the shortest decimal text of a double half up, as Spark does."""
    exact = f"cast(cast({value} AS varchar) AS decimal(38, 20))"
    return f"cast(round({exact}, {digits}) AS double)"


def _percent(part: str, whole: str, digits: int) -> str:
    return _round(f"({part}) / nullif({whole}, 0) * 100", digits)


_DAY_LIST = ", ".join(f"'{day}'" for day in DAYS)

_POSTS = f"""
posts AS (
    SELECT cast(doc_id AS varchar) AS id, text, lang, source AS author_id,
           regexp_extract_all(text, '{TAG_PATTERN}') AS tags,
           n_chars % 1000 AS likes, n_chars % 7 AS quotes,
           n_chars % 31 AS replies, n_chars % 101 AS retweets,
           [{_DAY_LIST}][doc_id % 5 + 1] AS day
    FROM documents
)"""

_TAG_ROWS = f"""{_POSTS},
tag_rows AS (
    SELECT id, author_id, text, unnest(tags) AS tag FROM posts WHERE lang = 'en'
)"""

_NO_WORDS = "text <> '' AND rtrim(text, ' ') = ''"

_LENGTH = f"""
CASE WHEN {_NO_WORDS} THEN 0
     ELSE len(list_filter(string_split_regex(rtrim(text, ' '), ' +'),
                          lambda w: NOT contains(w, '@') AND NOT contains(w, '#'))) END"""

_LEXICON = ", ".join(f"('{word}', {polarity})" for word, polarity in DEFAULT_LEXICON.items())

_SENTIMENT = f"""
WITH {_TAG_ROWS},
lexicon(word, polarity) AS (VALUES {_LEXICON}),
post_words AS (
    SELECT id, unnest(string_split(translate(lower(text), '.|,;?+!', ''), ' ')) AS word FROM posts
),
ratings AS (
    SELECT id, coalesce(sum(polarity), 0) AS rating
    FROM post_words LEFT JOIN lexicon USING (word) GROUP BY id
)
SELECT tag AS hashtag, {_round("avg(rating)", 2)} AS rating
FROM tag_rows JOIN ratings USING (id)
GROUP BY tag"""

_TOPIC_ROWS = f"""{_POSTS},
topic_rows AS (
    SELECT lang AS language, 'by table' AS domain_desc, 'Source ' || author_id AS domain_name,
           author_id AS domain_id, cast(NULL AS varchar) AS entity_desc, tag AS entity_name,
           lower(tag) AS entity_id, author_id || '.' || lower(tag) AS full_id,
           'Source ' || author_id || ': ' || tag AS context
    FROM (SELECT lang, author_id, unnest(tags) AS tag FROM posts)
)"""

_TOPIC_RANKING = f"""
WITH {_TOPIC_ROWS}
SELECT context AS context_topic, full_id AS full_id_topic, count(*) AS "topicCount"
FROM topic_rows GROUP BY ALL
ORDER BY "topicCount" DESC, context_topic, full_id_topic"""


def _popular_account_tags(factor: str) -> str:
    return f"""
WITH {_TAG_ROWS},
top_posts AS (
    SELECT author_id FROM posts WHERE lang = 'en'
    ORDER BY likes DESC NULLS LAST, id, author_id LIMIT 200
),
authors AS (SELECT author_id, {factor} AS factor FROM top_posts GROUP BY author_id)
SELECT tag AS "singleTags", cast(sum(factor) AS bigint) AS count
FROM tag_rows JOIN authors USING (author_id)
GROUP BY tag"""


def _context_rows(style: str) -> str:
    part, supplier = "cast(l_partkey % 40 AS varchar)", "cast(l_suppkey AS varchar)"
    if style == "legacy":
        part_label = f"'Range ' || {part} || ' (Range ' || {part} || ')'"
        supplier_label = f"'Supplier ' || {supplier} || ' (Supplier ' || {supplier} || ')'"
    else:
        part_label = f"'Part range: Range ' || {part}"
        supplier_label = f"'Supplier: Supplier ' || {supplier}"
    order_post = """'q' || cast(cast(l_quantity AS bigint) AS varchar) AS lang,
           cast(floor(l_extendedprice) AS bigint) AS l, cast(l_linenumber AS bigint) AS q,
           cast(l_quantity AS bigint) AS p, l_partkey % 97 AS r"""
    delivery_post = """lower(l_returnflag || l_linestatus) AS lang,
           cast(l_quantity AS bigint) AS l, 0 AS q, cast(l_linenumber AS bigint) AS p,
           l_suppkey % 13 AS r"""
    return f"""
context_rows AS (
    SELECT {part_label} AS context, {order_post} FROM lineitem
    UNION ALL SELECT {supplier_label} AS context, {order_post} FROM lineitem
    UNION ALL SELECT {supplier_label} AS context, {delivery_post} FROM lineitem
)"""


def _context_percent(style: str, limit: str) -> str:
    return f"""
WITH {_context_rows(style)},
counts AS (SELECT context, lang, count(*) AS n FROM context_rows GROUP BY ALL),
totals AS (SELECT context, cast(sum(n) AS bigint) AS topic_count FROM counts GROUP BY context),
shares AS (
    SELECT context, topic_count, lang, {_percent("n", "topic_count", 2)} AS percent
    FROM counts JOIN totals USING (context)
)
SELECT * FROM shares WHERE percent > 1.0
ORDER BY topic_count DESC, percent DESC, context, lang {limit}"""


def _interactions(style: str) -> str:
    return f"""{_context_rows(style)},
sums AS (
    SELECT context, lang, cast(sum(l) AS bigint) AS likes, cast(sum(q) AS bigint) AS quotes,
           cast(sum(p) AS bigint) AS replies, cast(sum(r) AS bigint) AS retweets,
           cast(sum(l) + sum(q) + sum(p) + sum(r) AS bigint) AS interactions
    FROM context_rows GROUP BY ALL
)"""


def _context_interactions(style: str, limit: str) -> str:
    return f"""
WITH {_interactions(style)}
SELECT context, lang, interactions FROM sums
ORDER BY interactions DESC, context, lang {limit}"""


_PROFILES = """
profiles AS (
    SELECT c_name AS name, cast(c_custkey AS varchar) AS username,
           (cast(floor(abs(c_acctbal) * 1000) AS bigint) + 1) / 1000000 AS followers
    FROM customer
)"""

_USER_POSTS = f"""{_PROFILES},
timeline AS (
    SELECT cast(user_id AS varchar) AS username, cast(floor(value * 100) AS bigint) AS l,
           event_id % 7 AS q, event_id % 31 AS p, cast(floor(value) AS bigint) AS r
    FROM events WHERE event_type <> 'error'
    UNION ALL
    SELECT cast(user_id AS varchar), cast(floor(value) AS bigint), 0, event_id % 5, event_id % 101
    FROM events WHERE event_type <> 'error'
),
user_posts AS (
    SELECT name AS "Name", username, {_round("followers", 2)} AS "Followers_Millions",
           l AS "Likes", q AS "Quotes", r AS "Retweets", p AS "Replies"
    FROM timeline JOIN profiles USING (username)
)"""

_ENGAGEMENT = f"""{_USER_POSTS},
sums AS (
    SELECT "Name", "Followers_Millions", sum("Likes") AS l, sum("Quotes") AS q,
           sum("Retweets") AS r, sum("Replies") AS p,
           sum("Likes" + "Quotes" + "Retweets" + "Replies") AS t,
           avg("Likes" + "Quotes" + "Retweets" + "Replies") AS m
    FROM user_posts GROUP BY ALL
),
figures AS (
    SELECT "Name", "Followers_Millions",
           {_round("cast(t AS double) / 1000", 1)} AS "Total_Engagement_Thousands",
           {_round("m / 1000", 1)} AS "Average_Engagement_Thousands",
           {_percent("cast(l AS double)", "t", 1)} AS "Like_Percent",
           {_percent("cast(q AS double)", "t", 1)} AS "Quote_Percent",
           {_percent("cast(r AS double)", "t", 1)} AS "Retweet_Percent",
           {_percent("cast(p AS double)", "t", 1)} AS "Reply_Percent"
    FROM sums
),
engagement AS (
    SELECT *,
           {_round('"Total_Engagement_Thousands" / nullif("Followers_Millions", 0)', 2)}
               AS "Total_Engagement_Per_Thous_Followers",
           {_round('"Average_Engagement_Thousands" / nullif("Followers_Millions", 0)', 2)}
               AS "Average_Engagement_Per_Thous_Followers"
    FROM figures
)"""


def _engagement(columns: str) -> str:
    return f"WITH {_ENGAGEMENT} SELECT {columns} FROM engagement"


_AVG_COLUMNS = '"Name", "Average_Engagement_Thousands", "Average_Engagement_Per_Thous_Followers"'
_TOTAL_COLUMNS = '"Name", "Total_Engagement_Thousands", "Total_Engagement_Per_Thous_Followers"'

_DAY_WORDS = f"""{_POSTS},
day_words AS (
    SELECT day, unnest(CASE WHEN {_NO_WORDS} THEN []
                            ELSE string_split(rtrim(text, ' '), ' ') END) AS word
    FROM posts WHERE text IS NOT NULL
)"""


def _day_tests() -> str:
    tests = []
    for day, (prefixes, exact) in WORD_PATTERNS.items():
        options = [f"word LIKE '{prefix}%'" for prefix in prefixes]
        options += [f"word = '{word}'" for word in exact]
        tests.append(f"(day = '{day}' AND ({' OR '.join(options)}))")
    return " OR ".join(tests)


_DAY_MATCHES = f"""
WITH {_DAY_WORDS}
SELECT day, word AS hashtag, count(*) AS count FROM day_words
WHERE {_day_tests()} GROUP BY day, word"""

_CURSOR = """
SELECT cast(conv_id AS varchar) AS username, count(*) FILTER (role <> 'system') AS hits,
       cast(min(CASE WHEN role <> 'system' THEN conv_id * 100 + turn END) AS varchar) AS until_id
FROM conversations GROUP BY conv_id"""

_CURSOR_BY_PATH = """
SELECT cast(conv_id % 16 AS varchar) AS username, count(*) FILTER (role <> 'system') AS hits,
       cast(min(CASE WHEN role <> 'system' THEN conv_id * 100 + turn END) AS varchar) AS until_id
FROM conversations GROUP BY conv_id % 16"""

_FLAT_POSTS = f"""
WITH {_POSTS}
SELECT id, lang, text, array_to_string(tags, ' ') AS tags, likes, len(tags) AS topics,
       'b' || (cast(id AS bigint) % 9) AS batch, NULL::varchar AS broken
FROM posts
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, '{{"data": {{"id": "' || id
FROM posts WHERE cast(id AS bigint) % 100 = 0"""

_PAGE_POSTS = """
SELECT cast(conv_id * 100 + turn AS varchar) AS id, role AS author_id, text,
       'b' || ((conv_id * 100 + turn) % 9) AS batch, NULL::varchar AS broken
FROM conversations WHERE role <> 'system'
UNION ALL
SELECT NULL, NULL, NULL, NULL, '{"data": [{"id": "' || (conv_id * 100 + turn)
FROM conversations WHERE role = 'system'"""

_FEED_FIELDS = f"""
WITH {_POSTS},
lines AS (
    SELECT id AS post, to_json({{'data': {{
        'id': id, 'text': text, 'lang': lang, 'author_id': author_id,
        'entities': {{'hashtags': list_transform(tags, lambda t: {{'tag': t}})}},
        'public_metrics': {{'like_count': likes, 'quote_count': quotes, 'reply_count': replies,
                            'retweet_count': retweets}},
        'context_annotations': list_transform(tags, lambda t: {{
            'domain': {{'id': author_id, 'name': 'Source ' || author_id,
                        'description': 'by table'}},
            'entity': {{'id': lower(t), 'name': t}}}}),
        'batch': 'b' || (cast(id AS bigint) % 9)}}}}) AS line
    FROM posts
),
found AS (
    SELECT post, CASE fullkey WHEN '$' THEN '$'
                 ELSE substr(regexp_replace(fullkey, '\\[\\d+\\]', '[]', 'g'), 3) END AS field,
           CASE t.type WHEN 'VARCHAR' THEN 'string' WHEN 'UBIGINT' THEN 'bigint'
                       ELSE lower(t.type) END AS type
    FROM lines, json_tree(line) t WHERE t.type <> 'NULL'
)
SELECT field, type, count(DISTINCT post) AS documents, count(*) AS values FROM found GROUP BY ALL
UNION ALL
SELECT '$', 'broken', count(*), count(*) FROM posts WHERE cast(id AS bigint) % 100 = 0"""

_ROTATED = """
WITH lines AS (
    SELECT count(*) + count(*) FILTER (doc_id % 100 = 0) AS n FROM documents
)
SELECT number // 100 AS file, count(*) AS lines
FROM (SELECT unnest(range(1, n + 1)) AS number FROM lines) GROUP BY ALL"""

# A late post counts if its day had not ended two days before the latest post on time.
_DAILY = f"""
WITH marks AS (
    SELECT max(ts) FILTER (event_id % {EVERY} <> 0) - INTERVAL 2 DAY AS before,
           max(ts) - INTERVAL 2 DAY AS after
    FROM events
)
SELECT cast(cast(ts AS date) AS varchar) AS day, count(*) AS tweet_count
FROM events, marks
WHERE event_type IS NOT NULL
  AND (event_id % {EVERY} <> 0 OR date_trunc('day', ts) + INTERVAL 1 DAY > before)
GROUP BY cast(ts AS date), after
HAVING date_trunc('day', min(ts)) + INTERVAL 1 DAY <= after"""

_DISTINCT_POSTS = f"""
WITH feed AS (
    SELECT * FROM events
    UNION ALL SELECT * FROM events WHERE event_id % {EVERY} = 0
    UNION ALL SELECT * FROM events WHERE event_id % {EVERY} = 0
)
SELECT DISTINCT ON (event_id) cast(event_id AS varchar) AS id, event_type AS text FROM feed"""

_FREQUENT_TAGS = f"""
WITH {_TAG_ROWS}
SELECT tag AS hashtag2, count(*) AS count FROM tag_rows
GROUP BY tag HAVING count(*) > {MIN_TAG_COUNT}"""

_AVG_LENGTH = f"""
WITH {_TAG_ROWS}, lengths AS (SELECT tag, {_LENGTH} AS length FROM tag_rows)
SELECT tag AS hashtag, {_round("avg(length)", 2)} AS "avgLength" FROM lengths
GROUP BY tag HAVING count(*) > {MIN_TAG_COUNT}"""

_DAY_WORD_COUNTS = f"""
WITH {_DAY_WORDS},
per_day AS (SELECT day, count(*) AS n FROM posts WHERE text IS NOT NULL GROUP BY day),
counts AS (SELECT day, word, count(*) AS count FROM day_words GROUP BY ALL)
SELECT day, word, count, count * 100 / n AS "(% format)" FROM counts JOIN per_day USING (day)"""

_INDEXED_MATCHES = f"""
WITH {_DAY_WORDS},
pattern_words AS (
    SELECT day, unnest(string_split(text, ' ')) AS word FROM posts
    WHERE cast(id AS bigint) % 3 = 0
),
patterns AS (
    SELECT DISTINCT day, length(word) % 2 = 0 AS exact,
           CASE WHEN length(word) % 2 = 0 THEN word
                ELSE left(word, length(word) % 3 + 3) END AS pattern
    FROM pattern_words WHERE length(word) >= 6
),
counts AS (SELECT day, word, count(*) AS count FROM day_words GROUP BY ALL)
SELECT day, word AS hashtag, count FROM counts
WHERE EXISTS (SELECT 1 FROM patterns p WHERE p.exact AND p.day = counts.day AND p.pattern = word)
   OR EXISTS (SELECT 1 FROM patterns p WHERE NOT p.exact AND p.day = counts.day
              AND p.pattern = left(word, 3))
   OR EXISTS (SELECT 1 FROM patterns p WHERE NOT p.exact AND p.day = counts.day
              AND p.pattern = left(word, 4))
   OR EXISTS (SELECT 1 FROM patterns p WHERE NOT p.exact AND p.day = counts.day
              AND p.pattern = left(word, 5))"""

_DAY_TWEET_COUNT = f"""
WITH {_POSTS}
SELECT day, count(*) AS tweet_count FROM posts WHERE text IS NOT NULL GROUP BY day"""

ORACLES: dict[str, str] = {
    "hashtag_base": f"""
WITH {_POSTS}
SELECT text, array_to_string(tags, ' ') AS hashtag FROM posts WHERE lang = 'en'""",
    "frequent_tags": _FREQUENT_TAGS,
    "avg_tweet_length_by_tag": _AVG_LENGTH,
    "tag_sentiment_desc": _SENTIMENT,
    "tag_sentiment_asc": _SENTIMENT,
    "tag_sentiment_joined": _SENTIMENT,
    "tag_sentiment_from_files": _SENTIMENT,
    "lang_topic_rows": f"WITH {_TOPIC_ROWS} SELECT * FROM topic_rows",
    "lang_topic_ranking": f"""
WITH {_TOPIC_ROWS}
SELECT language, context, full_id, count(*) AS count FROM topic_rows GROUP BY ALL""",
    "topic_ranking_top": f"{_TOPIC_RANKING} LIMIT 20",
    "topic_ranking": _TOPIC_RANKING,
    "lang_share_top_topics": f"""
WITH {_TOPIC_ROWS},
top_topics AS (
    SELECT context AS context_topic, full_id AS full_id_topic, count(*) AS "topicCount"
    FROM topic_rows GROUP BY ALL
    ORDER BY "topicCount" DESC, context_topic, full_id_topic LIMIT 10
),
counts AS (
    SELECT language, context, full_id, count(*) AS count FROM topic_rows GROUP BY ALL
),
shares AS (
    SELECT context_topic, full_id_topic, "topicCount", language, context, count,
           count / "topicCount" AS proportion
    FROM counts JOIN top_topics ON full_id = full_id_topic
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY context_topic, full_id_topic
                                 ORDER BY proportion DESC, language, context) AS place
    FROM shares
)
SELECT context_topic, full_id_topic, "topicCount", language, count, proportion
FROM ranked WHERE place <= 10""",
    "popular_users_metrics": f"""
WITH {_POSTS}
SELECT author_id AS user, cast(sum(likes) AS bigint) AS "sum(likes)",
       cast(sum(quotes) AS bigint) AS "sum(quotes)",
       cast(sum(replies) AS bigint) AS "sum(replies)",
       cast(sum(retweets) AS bigint) AS "sum(retweets)"
FROM posts GROUP BY author_id""",
    "multi_tag_counts": f"""
WITH {_TAG_ROWS}, per_id AS (SELECT id, count(*) AS n FROM tag_rows GROUP BY id)
SELECT tag AS tags, count(*) AS count FROM tag_rows JOIN per_id USING (id)
WHERE n >= 2 GROUP BY tag""",
    "popular_account_tags": _popular_account_tags("count(*)"),
    "popular_account_tags_distinct": _popular_account_tags("1"),
    "context_lang_percent": _context_percent("legacy", "LIMIT 50"),
    "context_lang_percent_all": _context_percent("domain", ""),
    "context_lang_interactions": _context_interactions("legacy", "LIMIT 50"),
    "context_lang_interactions_all": _context_interactions("domain", ""),
    "context_interaction_breakdown": f"""
WITH {_interactions("legacy")}
SELECT context, lang, interactions,
       {_percent("likes", "interactions", 2)} AS like_percent,
       {_percent("quotes", "interactions", 2)} AS quote_percent,
       {_percent("replies", "interactions", 2)} AS reply_percent,
       {_percent("retweets", "interactions", 2)} AS retweet_percent
FROM sums""",
    "user_profiles": f"""
WITH {_PROFILES}
SELECT name, username, followers AS "Followers_Millions" FROM profiles""",
    "tweet_metrics_by_user": f"WITH {_USER_POSTS} SELECT * FROM user_posts",
    "tweet_metrics_by_user_salted": f"WITH {_USER_POSTS} SELECT * FROM user_posts",
    "user_engagement": _engagement("*"),
    "avg_engagement_rank": _engagement(_AVG_COLUMNS),
    "avg_engagement_per_follower_rank": _engagement(_AVG_COLUMNS),
    "total_engagement_rank": _engagement(_TOTAL_COLUMNS),
    "total_engagement_per_follower_rank": _engagement(_TOTAL_COLUMNS),
    "engagement_profile": _engagement(
        """"Name", "Followers_Millions", "Total_Engagement_Per_Thous_Followers",
        "Average_Engagement_Per_Thous_Followers", "Like_Percent", "Quote_Percent",
        "Retweet_Percent", "Reply_Percent" """
    ),
    "day_tweet_count": _DAY_TWEET_COUNT,
    "day_word_counts": _DAY_WORD_COUNTS,
    "day_tag_matches": _DAY_MATCHES,
    "day_tag_matches_frame": _DAY_MATCHES,
    "search_page_cursor": _CURSOR,
    "search_page_cursor_by_pattern": _CURSOR,
    "search_page_cursor_by_path": _CURSOR_BY_PATH,
    "pages_to_tweets": _PAGE_POSTS,
    "json_to_parquet": _FLAT_POSTS,
    "stream_land": _FLAT_POSTS,
    "report_csv": _context_percent("legacy", "LIMIT 50"),
    "frequent_tags_sketched": _FREQUENT_TAGS,
    "avg_tweet_length_by_tag_sql": _AVG_LENGTH,
    "tag_sentiment_sql": _SENTIMENT,
    "day_word_counts_sql": _DAY_WORD_COUNTS,
    "day_tweet_count_stored": _DAY_TWEET_COUNT,
    "day_word_counts_stored": _DAY_WORD_COUNTS,
    "day_tag_matches_indexed": _INDEXED_MATCHES,
    "popular_account_tags_stream": _popular_account_tags("count(*)"),
    "user_engagement_bucketed": _engagement("*"),
    "tweet_metrics_by_user_bucketed": f"WITH {_USER_POSTS} SELECT * FROM user_posts",
    "feed_fields": _FEED_FIELDS,
    "json_to_parquet_discovered": _FLAT_POSTS,
    "stream_rotate": _ROTATED,
    "stream_rotate_posts": _FLAT_POSTS,
    "stream_daily_counts": _DAILY,
    "stream_distinct_posts": _DISTINCT_POSTS,
    "search_page_cursor_stream": _CURSOR,
}
