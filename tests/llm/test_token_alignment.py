"""Alignment of two tokenizers against a plain loop over tokens."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from corpus import collected, documents, empty, near_copies, odd_documents, odd_rows, with_clashes
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postlark.llm import token_alignment
from postlark.llm.token_alignment import ByteLevel, SentencePieces


@pytest.fixture(scope="module")
def sides():
    return (
        ByteLevel(public_tokenizers.path("byte_bpe_50k.json")),
        SentencePieces(public_tokenizers.path("piece_bpe_32k.model")),
    )


class Plain:
    """One text at a time, token by token, with the reference library for A."""

    def __init__(self, sides, link="end"):
        self.a, self.b = sides
        self.link = link
        self.library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.library.encode_special_tokens = True
        self.encode_b = self.b.encoder()

    def tokens(self, text):
        if not text:
            return [], []
        a = self.library.encode(" " + text, add_special_tokens=False).ids
        b = self.encode_b([text])[0].tolist()
        whole = (" " + text).encode()
        for side, ids in ((self.a, a), (self.b, b)):
            if b"".join(side.pieces[i] for i in ids) != whole:
                return [], []
        return self.spans(self.a, a), self.spans(self.b, b)

    @staticmethod
    def spans(side, ids):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at + len(side.pieces[i])))
            at += len(side.pieces[i])
        return out

    def row(self, text):
        a, b = self.tokens(text)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for cut in cuts:
            parts = [[str(i) for i, s, e in side if start <= s and e <= cut] for side in (a, b)]
            groups.append("|".join(",".join(part) for part in parts))
            start = cut
        links = []
        for i, s, e in a:
            for j, u, v in b:
                if (e == v) if self.link == "end" else (s < v and u < e):
                    links.append((i, j))
        written = ";".join(groups)
        hashed = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        return len(a), len(b), len(groups), links, hashed

    def result(self, rows):
        found = [(key, self.row(text)) for key, text in rows]
        counts = Counter(link for _, row in found for link in row[3])
        highest = {}
        for (_, j), n in counts.items():
            highest[j] = max(highest.get(j, 0), n)
        out = []
        for key, (n_a, n_b, n_groups, links, hashed) in found:
            best = sum(counts[link] == highest[link[1]] for link in links)
            total = sum(counts[link] for link in links)
            out.append((key, n_a, n_b, n_groups, len(links), best, total, hashed))
        return sorted(out, key=repr)


def short_rows():
    """The odd rows, with the long ones cut so that plain loops end."""
    return [(row[0], row[1] and row[1][:1500]) for row in odd_rows()]


ROWS = [
    (20, "naïve café ▁ mark"),
    (21, "ünïcödé \U0001f600\U0001f469‍\U0001f469 ﬁn"),
    (22, "tabs\tand\r\nlines  two"),
    (23, "<s> <0x41> <unk> <|endoftext|>"),
    (24, "日本語のテキスト, 한국어"),
    (25, "a\0b \x1f"),
    (26, "  x"),
]


@pytest.mark.parametrize("max_pairs", [0, 40, 1 << 20])
def test_equals_plain_loops(spark, sides, max_pairs):
    rows = short_rows() + ROWS + near_copies(families=2, members=4)
    found = token_alignment.digest(documents(spark, rows), *sides, max_pairs=max_pairs)
    assert collected(found) == Plain(sides).result(rows)


def test_overlapping_tokens_as_links(spark, sides):
    rows = ROWS + short_rows()
    found = token_alignment.digest(documents(spark, rows), *sides, link="overlap", max_pairs=30)
    assert collected(found) == Plain(sides, "overlap").result(rows)
    with pytest.raises(ValueError, match="link"):
        token_alignment.aligned(documents(spark, rows), *sides, link="start")


def test_odd_input(spark, sides):
    plain = token_alignment.digest(odd_documents(spark), *sides)
    assert collected(plain) == collected(
        token_alignment.digest(with_clashes(odd_documents(spark)), *sides)
    )
    assert plain.count() == len(odd_rows())
    assert collected(token_alignment.digest(empty(spark), *sides)) == []


def test_texts_without_tokens(spark, sides):
    rows = [(1, None), (2, ""), (3, "a ▁ b")]
    assert collected(token_alignment.digest(documents(spark, rows), *sides)) == [
        (n, 0, 0, 0, 0, 0, 0, "") for n in (1, 2, 3)
    ]


def test_groups_cover_the_text(spark, sides):
    rows = ROWS[1:3] + [(30, "plain words and naïve ones")]
    found = token_alignment.token_groups(documents(spark, rows), *sides)
    assert found.select(F.min(F.size("a")), F.min(F.size("b"))).first() == (1, 1)
    for key, text in rows:
        groups = found.where(F.col("doc_id") == key).orderBy("place").collect()
        whole = (" " + text).encode()
        assert [g.start for g in groups] == [0, *[g.end for g in groups[:-1]]]
        for g in groups:
            for side, ids in zip(sides, (g.a, g.b), strict=True):
                assert b"".join(side.pieces[i] for i in ids) == whole[g.start : g.end]


def test_byte_level_ids_are_those_of_the_library(sides):
    """Random code points and long runs, which the words of both libraries must cut alike."""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    rng = random.Random(4)
    points = [rng.randrange(1, 0x30000) for _ in range(4000)]
    kept = [chr(p) for p in points if not 0xD800 <= p < 0xE000]
    texts = [f"a{c}b 1{c}2 {c} {c}x .{c}!\n{c}{c}  '{c}" for c in kept]
    texts += ["x" * 50_000, " " * 50_000, "\n" * 50_000, "é1" * 20_000]
    encode = sides[0].encoder()
    for text, ids in zip(texts, encode(texts), strict=True):
        assert library.encode(" " + text, add_special_tokens=False).ids == ids.tolist()
