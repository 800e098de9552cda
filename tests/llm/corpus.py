"""Small corpora for the tests of the corpus operators."""

import random
import re

from pyspark.sql import functions as F

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}

# Names that operators use for their own columns.
CLASHING = "score quality kept n_words size taken target block rank label _kept _text _id hash".split()


def documents(spark, rows):
    """Rows of (id, text) or (id, text, source) as documents."""
    filled = [
        (row[0], row[1], "en", row[2] if len(row) > 2 else "s", len(row[1] or "")) for row in rows
    ]
    return spark.createDataFrame(filled, DOCS)


def odd_rows():
    """Missing, empty, blank, repeated and very long texts, and missing ids."""
    long = " ".join(f"w{n % 4001}" for n in range(60_000))
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, "same text here for two rows " * 12),
        (5, "same text here for two rows " * 12),
        (6, "same text here for two rows " * 12),
        (7, long),
        (8, "x" * 100_000),
        (9, "é中\U0001f600\0 <|endoftext|> 'tis\n\n\nend"),
        (None, "a row without an id " * 20),
        (None, None),
    ]


def odd_documents(spark):
    return documents(spark, odd_rows())


def with_clashes(df):
    """The same rows with more columns, called as operators call theirs."""
    return df.withColumns({name: F.lit(None).cast("string") for name in CLASHING})


def empty(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, quality INT, toxic INT")


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, vocabulary=600):
    return " ".join(f"{'abcdefghij'[rng.randrange(10)]}{rng.randrange(vocabulary)}" for _ in range(n))


def near_copies(seed=5, families=6, members=12):
    """Families of texts with a few words changed, from nearly all alike to hardly."""
    rng = random.Random(seed)
    out, number = [], 100
    for _ in range(families):
        base = prose(rng, rng.randint(40, 160)).split()
        for _ in range(members):
            own = list(base)
            for _ in range(int(len(own) * rng.choice([0, 0.005, 0.01, 0.02, 0.03, 0.05]))):
                own[rng.randrange(len(own))] = f"z{rng.randrange(10**6)}"
            out.append((number, " ".join(own)))
            number += 1
    return out + [(number + n, prose(rng, rng.randint(1, 60))) for n in range(40)]


def collected(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
