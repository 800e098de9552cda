import hashlib
import random
import struct

import pytest
from corpus import collected, documents, empty, odd_documents, with_clashes
from pyspark.sql import functions as F

from postlark.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return (
        len(ids),
        hashlib.sha256(packed).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(),
    )


def texts():
    rng = random.Random(3)
    letters = "ab'stlrevmd 12 \n\t  \u0085.,<|>é中\U0001f600́٠²Ⅷ​﻿\0\x1c　"
    out = ["<|endoftext|>", " <|endoftext|> x", "a  <|endoftext|>b", "!!<|endoftext|>!!", "'s 's"]
    out += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    parts = [*letters, "<|endoftext|>", "  ", "'re"]
    return out + ["".join(rng.choice(parts) for _ in range(20)) for _ in range(200)]


@pytest.mark.parametrize("most", [bpe.MAX_TABLE_WORDS, 20, 0])
def test_equals_the_library(spark, vocabulary, library, most):
    rows = list(enumerate(texts()))
    found = bpe.encode(documents(spark, rows).repartition(3), vocabulary, most)
    own = dict(rows)
    for row in found.collect():
        assert tuple(row)[1:] == expected(library, own[row.doc_id]), own[row.doc_id]


def test_the_words_make_up_the_text(spark, vocabulary):
    docs = documents(spark, enumerate(texts()))
    joined = F.array_join(bpe.words(F.col("text"), vocabulary), "")
    assert docs.where(joined != F.col("text")).count() == 0


def test_the_table_is_bounded(spark, vocabulary):
    text = "a a a b b c " * 3 + "x" * 40 + " " + "x" * 40 + " rare"
    table = bpe.word_table(documents(spark, [(1, text)]), vocabulary, 2)
    words = {row.word for row in table.collect()}
    assert len(words) <= 2 and words <= {" a", "a", " b", " c"}


def test_odd_input(spark, vocabulary, library):
    docs = odd_documents(spark)
    found = collected(bpe.encode(docs, vocabulary))
    rows = [(row.doc_id, *expected(library, row.text)) for row in docs.collect()]
    assert found == sorted(rows, key=repr)
    assert found == collected(bpe.encode(with_clashes(docs), vocabulary))
    assert bpe.encode(empty(spark), vocabulary).collect() == []
