import collections
import random

import numpy as np
import pytest
from corpus import (
    LOWER,
    collected,
    documents,
    empty,
    near_copies,
    odd_documents,
    prose,
    with_clashes,
    words,
)

from postlark.llm import graph, ngram_join
from postlark.session import stored


def shingles(text):
    own = words((text or "").translate(LOWER))
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def brute(rows):
    """Size of the set and smallest id reachable, by id; rows must differ in their ids."""
    sets = {number: shingles(text) for number, text in rows}
    parent = {number: number for number in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for number, own in sets.items():
        for shingle in own:
            holders[shingle].append(number)
    pairs = {(a, b) for held in holders.values() for a in held for b in held if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return sorted((n, len(own), root(n)) for n, own in sets.items())


@pytest.fixture(scope="module")
def rows():
    found = near_copies()
    number = found[-1][0] + 1
    return [*found, (number, found[3][1]), (number + 1, found[3][1].upper()), (number + 2, "A b"),
            (number + 3, "a  B\n"), (number + 4, "a b c"), (number + 5, " "), (number + 6, None)]


def test_equals_all_pairs(spark, rows):
    assert collected(ngram_join.linked(documents(spark, rows).repartition(5))) == sorted(
        brute(rows), key=repr
    )


def no_links(docs, pairs):
    return stored(pairs.limit(0), "none")


@pytest.mark.parametrize("group_tokens", [1, 300, 1 << 16])
def test_links_between_families_are_found(spark, rows, monkeypatch, group_tokens):
    """Without the first step every link has to come from pairs of groups."""
    monkeypatch.setattr(ngram_join, "family_links", no_links)
    monkeypatch.setattr(ngram_join, "GROUP_TOKENS", group_tokens)
    monkeypatch.setattr(ngram_join, "MATRIX", 1000)
    assert collected(ngram_join.linked(documents(spark, rows))) == sorted(brute(rows), key=repr)


def test_small_groups_and_few_bands_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP_TOKENS", 200)
    monkeypatch.setattr(ngram_join, "BANDS", 1)
    monkeypatch.setattr(ngram_join.sieve, "BITS", 8)
    assert collected(ngram_join.linked(documents(spark, rows))) == sorted(brute(rows), key=repr)


def test_block_links_equal_all_pairs():
    """Links of two groups connect what comparing all members connects."""
    rng = np.random.default_rng(3)
    for _ in range(60):
        base = rng.integers(0, 1 << 60, 40, dtype=np.uint64)
        members = []
        for number in range(14):
            own = base[rng.random(40) > rng.choice([0.0, 0.1, 0.2])]
            own = np.unique(np.concatenate([own, rng.integers(0, 1 << 60, rng.integers(0, 6), dtype=np.uint64)]))
            members.append({"rep": number, "family": int(rng.integers(0, 9)), "tokens": own.tobytes()})
        for left, right in ((members[:7], members[7:]), (members, None)):
            pairs = [(a, b) for a in left for b in (right or left) if a["family"] != b["family"]]
            close = {
                frozenset((a["family"], b["family"]))
                for a, b in pairs
                if ngram_join.similar(*(np.frombuffer(m["tokens"], dtype=np.uint64) for m in (a, b)))
            }
            blocks = ngram_join.Block(left), ngram_join.Block(right) if right else None
            family = {m["rep"]: m["family"] for m in members}
            found = {frozenset((family[a], family[b])) for a, b in ngram_join.block_links(*blocks)}
            assert found <= close and joined(found) == joined(close)


def joined(edges):
    """The sets of connected nodes."""
    out = []
    for edge in edges:
        touching = [own for own in out if own & edge]
        out = [own for own in out if not own & edge] + [edge.union(*touching)]
    return {frozenset(own) for own in out}


def threshold_copies(n, low, high, seed=1):
    """Copies of a text of 300 words with some words changed, about the threshold or above it."""
    rng = random.Random(seed)
    base = prose(rng, 300).split()
    out = []
    for number in range(n):
        own = list(base)
        for place in rng.sample(range(300), rng.randint(low, high)):
            own[place] = f"z{rng.randrange(10**9)}"
        out.append((number, " ".join(own)))
    return out


@pytest.mark.parametrize(("low", "high"), [(5, 9), (1, 6)])
def test_large_families_do_not_make_all_pairs(spark, monkeypatch, low, high):
    """Stored rows of a stage grow with the copies, not with their pairs."""
    largest = {}
    keep = ngram_join.stored

    def counting(df, purpose):
        out = keep(df, purpose)
        largest[n] = max(largest.get(n, 0), out.count() if purpose != "token-matrix" else 0)
        if purpose == "group-pairs":
            assert out.count() <= (2 + n * 300 / ngram_join.GROUP_TOKENS) ** 2
        return out

    monkeypatch.setattr(ngram_join, "stored", counting)
    for n in (200, 400):
        copies = threshold_copies(n, low, high)
        found = ngram_join.linked(documents(spark, copies))
        assert collected(found) == sorted(brute(copies), key=repr)
    assert largest[400] < 2.6 * largest[200]


def test_one_of_each_stays(spark, rows):
    kept = {row.doc_id for row in ngram_join.one_of_each(documents(spark, rows)).collect()}
    assert kept == {number for number, _, component in brute(rows) if component == number}


def test_odd_input(spark):
    docs = odd_documents(spark)
    found = collected(ngram_join.linked(docs))
    assert len(found) == docs.count()
    assert found == collected(ngram_join.linked(with_clashes(docs)))
    components = {row[0]: row[2] for row in found if row[0] is not None}
    assert components == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8, 9: 9}
    assert [row[2] for row in found if row[0] is None] == [None, None]
    assert ngram_join.one_of_each(docs).columns == docs.columns
    assert ngram_join.linked(empty(spark)).collect() == []
    assert ngram_join.one_of_each(empty(spark)).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(n, n + 1) for n in range(200, 260)]
    star = [(5, n) for n in range(10, 60)]
    edges = spark.createDataFrame([*chain, *star, (1, 1)], "a bigint, b bigint").repartition(4)
    found = {row.node: row.component for row in graph.components(edges).collect()}
    assert found == {**{n: 200 for n in range(200, 261)}, **{n: 5 for n in [5, *range(10, 60)]}}
