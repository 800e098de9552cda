"""Small nested inputs for the operator tests."""

import json

from postlark import schemas


def frame(spark, schema, documents):
    """Documents as Spark reads them from JSON with the declared schema."""
    lines = spark.createDataFrame([(json.dumps(d),) for d in documents], "value STRING")
    parsed = lines.selectExpr(f"from_json(value, '{schema}') AS document")
    return parsed.select("document.*")


def post(id="1", text="x", lang="en", author="a", tags=(), metrics=(0, 0, 0, 0), topics=None):
    like, quote, reply, retweet = metrics
    document = {
        "id": id,
        "text": text,
        "lang": lang,
        "author_id": author,
        "public_metrics": {
            "like_count": like,
            "quote_count": quote,
            "reply_count": reply,
            "retweet_count": retweet,
        },
    }
    if tags is not None:
        document["entities"] = {"hashtags": [{"tag": tag} for tag in tags]}
    if topics is not None:
        document["context_annotations"] = topics
    return document


def topic(domain="D", entity="E", domain_id="1", entity_id="2"):
    return {
        "domain": {"id": domain_id, "name": domain, "description": "about"},
        "entity": {"id": entity_id, "name": entity},
    }


def stream(spark, posts):
    return frame(spark, schemas.STREAM_POST, [{"data": p} for p in posts])


def rows(df):
    return [tuple(row) for row in df.collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
