"""The leading posts of a stream: a table of k rows that every batch brings up to date.

Leading posts can be merged: those of several files, days or batches are the leading ones among the
leading of each, ties by id included, whatever the split. So a running top needs no state but its own
rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from postlark.operators.tags import leading_posts, ranked_posts
from postlark.streaming.commits import BatchTable

_POSTS = "author_id STRING, likes BIGINT, id STRING"


def merged_top(tops: list[DataFrame], top_n: int = 200) -> DataFrame:
    """The leading posts of all from the leading posts of each."""
    return ranked_posts(reduce(DataFrame.unionByName, tops), top_n)


class RunningTop:
    def __init__(self, spark: SparkSession, folder: str, lang: str = "en", top_n: int = 200):
        self.lang, self.top_n = lang, top_n
        self.table = BatchTable(spark, folder, _POSTS)

    def add(self, posts: DataFrame, batch: int) -> None:
        """Take up the posts of one batch."""
        if not self.table.done(batch):
            own = leading_posts(posts, self.lang, self.top_n)
            self.table.replace(merged_top([self.table.read(), own], self.top_n), batch)

    def posts(self) -> DataFrame:
        """``author_id``, ``likes``, ``id`` of the leading posts so far."""
        return self.table.read()


def follow(
    posts: DataFrame, top: RunningTop, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Start following a stream of posts; see ``landing.land`` for the interval."""
    writer = posts.writeStream.foreachBatch(top.add).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()
