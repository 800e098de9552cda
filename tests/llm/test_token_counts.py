import random

import pytest
from corpus import collected, documents, empty, odd_documents, with_clashes

from postlark.llm import token_counts

tokenizers = pytest.importorskip("tokenizers")

PIECES = [
    ("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0),
    ("ba", -2.0), ("aba", -3.0), ("bb", -1.5), ("▁ab", -3.5), ("é", -1.25),
]
BYTES = [(f"<0x{b:02X}>", 0.0) for b in range(256)]


def library(vocabulary, by_bytes):
    model = tokenizers.models.Unigram(vocabulary, unk_id=0, byte_fallback=by_bytes)
    tokenizer = tokenizers.Tokenizer(model)
    tokenizer.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(
        replacement="▁", prepend_scheme="always", split=True
    )
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("by_bytes", [False, True])
def test_ties_and_unknown_characters(by_bytes):
    vocabulary = PIECES + BYTES * by_bytes
    counter, count = token_counts.Counter(vocabulary), library(vocabulary, by_bytes)
    rng = random.Random(1)
    texts = ["", " ", "  ", "▁", "a▁ b", "<0x41>", "cc c", "é中é"]
    texts += ["".join(rng.choice("abcé中▁ \n") for _ in range(rng.randint(0, 25))) for _ in range(2000)]
    for text in texts:
        assert counter.text(text) == count(text), text


def test_forgetting_words_changes_nothing():
    few = token_counts.Counter(PIECES, kept_words=1)
    many = token_counts.Counter(PIECES)
    text = "ab ba ab aba ba ab " * 5
    assert few.text(text) == many.text(text) and len(few.kept) == 1


def test_half_of_the_byte_pieces_is_refused():
    with pytest.raises(ValueError):
        token_counts.Counter(PIECES + BYTES[:128])


def test_the_given_vocabulary(spark, data):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path = public_tokenizers.path("piece_bpe_32k.model")
    vocabulary = token_counts.sentencepiece_vocabulary(path)
    count = library(vocabulary, True)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    found = {row.doc_id: row.n_tokens for row in token_counts.counts(docs, vocabulary).collect()}
    assert found == {row.doc_id: count(row.text) for row in docs.collect()}


def test_odd_input(spark):
    docs = odd_documents(spark)
    count = library(PIECES + BYTES, True)
    found = collected(token_counts.counts(docs, PIECES + BYTES))
    assert found == sorted(((row.doc_id, count(row.text)) for row in docs.collect()), key=repr)
    assert found == collected(token_counts.counts(with_clashes(docs), PIECES + BYTES))
    assert token_counts.counts(empty(spark), PIECES).collect() == []
