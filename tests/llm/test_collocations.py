"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import LOWER, collected, documents, empty, odd_documents, odd_rows, with_clashes

from postlark.llm import collocations

DOCS = "doc_id BIGINT, text STRING, lang STRING"


def brute(rows, min_count=10, drop_percent=50, limit=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            totals[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts[lang, words[i : i + size]] += 1
    found = {}
    for (lang, words), a in counts.items():
        if len(words) > 1 and a >= min_count:
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[lang, words[:k]], counts[lang, words[k:]]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found[lang, words] = (score, a, left, right)
    longest = defaultdict(int)
    for (lang, words), (_, a, *_) in found.items():
        if len(words) == 3:
            for part in (words[:2], words[1:]):
                longest[lang, part] = max(longest[lang, part], a)
    out = []
    for lang in {lang for lang, _ in found}:
        own = [
            (-score, -a, " ".join(words).encode(), left, right)
            for (of, words), (score, a, left, right) in found.items()
            if of == lang
            and not (longest[lang, words] and 100 * longest[lang, words] >= drop_percent * a)
        ]
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:limit], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out, key=repr)


def text_rows(seed, n=300, words=25):
    """Words of skewed frequency with fixed phrases among them, in some languages."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 40)):
            pick = rng.random()
            if pick < 0.15:
                parts.append(rng.choice(["New York City", "ad hoc", "new York", "à la carte", "x y z"]))
            elif pick < 0.2:
                parts.append(rng.choice([".", "!\r\n", ",", "\x0b", "\t", "?;"]))
            else:
                parts.append(f"w{min(rng.randrange(words), rng.randrange(words))}")
        out.append((" ".join(parts), rng.choice(["en", "en", "fr", None, "und", ""])))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(n, t, lang) for n, (t, lang) in enumerate(rows)], DOCS)


@pytest.mark.parametrize(("limit", "min_count"), [(2000, 10), (20, 3), (3, 5), (1, 2)])
def test_equals_counting_all_phrases(spark, limit, min_count):
    rows = text_rows(limit)
    found = collocations.collocations(frame(spark, rows), min_count=min_count, limit=limit)
    assert collected(found) == brute(rows, min_count=min_count, limit=limit)
    assert found.count()


@pytest.mark.parametrize("drop_percent", [1, 50, 90, 100])
def test_frontier_grows_until_enough_survive(spark, drop_percent):
    """Pairs drop out under their longer phrases, so the first frontier is too small."""
    rows = [("a b c d. e f g. h i j. k l. m n. o p q", "en")] * 30 + text_rows(5, 60)
    found = collocations.collocations(
        frame(spark, rows), drop_percent=drop_percent, limit=6, growth=2
    )
    assert collected(found) == brute(rows, drop_percent=drop_percent, limit=6)


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits."""
    rows = [(3_000_000_007, 3_000_000_019, 3_000_000_037), (10**14, 10**15 - 1, 10**15 - 1)]
    found = spark.createDataFrame(rows, "a bigint, l bigint, r bigint").select(
        "a", "l", "r", collocations._score(*map(collocations.F.col, ("a", "l", "r"))).alias("s")
    )
    for row in found.collect():
        assert row.s == 1_000_000 * row.a * row.a // (row.l * row.r)


def test_tasks_send_on_what_they_cannot_hold(spark, monkeypatch):
    """Sums are right when a task forgets its words after every chunk."""
    monkeypatch.setattr(collocations, "_HELD", 20)
    monkeypatch.setattr(collocations, "_CHUNK_BYTES", 100)
    monkeypatch.setattr(collocations, "_SENT", 3)
    rows = text_rows(8, 200)
    found = collocations.collocations(frame(spark, rows), min_count=4, limit=50)
    assert collected(found) == brute(rows, min_count=4, limit=50)


def test_equal_keys_are_noticed(spark, monkeypatch):
    """Words whose keys are equal get other keys."""
    hashed = collocations._word_keys

    def equal_at_first(langs, words, seed):
        keys = hashed(langs, words, seed)
        return keys % np.uint64(7) if seed == 0 else keys

    monkeypatch.setattr(collocations, "_word_keys", equal_at_first)
    rows = text_rows(9, 100)
    _, seed = collocations._key_table(frame(spark, rows))
    assert seed == 1
    found = collocations.collocations(frame(spark, rows), min_count=3)
    assert collected(found) == brute(rows, min_count=3)


def test_odd_input(spark):
    rows = [(row[1], "en") for row in odd_rows()]
    plain = collocations.collocations(odd_documents(spark))
    assert collected(plain) == brute(rows)
    clashing = collocations.collocations(with_clashes(odd_documents(spark)))
    assert collected(clashing) == brute(rows)
    assert collected(collocations.collocations(empty(spark))) == []
    assert collected(collocations.collocations(documents(spark, [(1, None), (2, "one")]))) == []


def test_a_bitmap_of_pairs_takes_one_worker(spark):
    import numpy as np

    rows = [(n, n * 7) for n in range(500)]
    pairs = spark.createDataFrame(rows, "k1 bigint, k2 bigint")
    bitmap = collocations._pair_bitmap(pairs)
    first, second = (np.array(column) for column in zip(*rows, strict=True))
    assert collocations.passes(collocations._pair_keys(first, second), bitmap).all()
    found = collocations.sieve(
        pairs, 16, lambda batch: collocations._pair_keys(*[c.to_numpy() for c in batch.columns])
    )
    assert collocations.passes(collocations._pair_keys(first, second), found).all()
    assert collocations.passes(np.arange(10_000), found).mean() < 0.05
