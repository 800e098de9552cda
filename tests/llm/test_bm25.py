import collections
import math
import random

import pytest
from corpus import LOWER, collected, documents, empty, odd_documents, prose, with_clashes, words

from postlark.llm import bm25


def brute(rows, k=bm25.TOP):
    texts = {n: words((text or "").translate(LOWER)) for n, text in rows if n is not None}
    have = collections.Counter(w for own in texts.values() for w in set(own))
    n, mean = len(texts), sum(map(len, texts.values())) / len(texts)
    out = {}
    for query in (q for q in texts if q % bm25.EVERY == 0):
        scores = []
        for number, own in texts.items():
            counts, total = collections.Counter(own), 0.0
            scale = bm25.K1 * (1 - bm25.B + bm25.B * len(own) / mean)
            for w in set(texts[query]) & set(counts):
                idf = math.log1p((n - have[w] + 0.5) / (have[w] + 0.5))
                total += idf * counts[w] * (bm25.K1 + 1) / (counts[w] + scale)
            if total > 0:
                scores.append((-total, number))
        out[query] = [(number, -score) for score, number in sorted(scores)[:k]]
    return {query: found for query, found in out.items() if found}


def compare(found, expected):
    own = collections.defaultdict(list)
    for row in sorted(found, key=lambda row: (row.query_id, row["rank"])):
        own[row.query_id].append((row.doc_id, row.score))
    assert own.keys() == expected.keys()
    for query, best in expected.items():
        assert [n for n, _ in own[query]] == [n for n, _ in best]
        assert [s for _, s in own[query]] == pytest.approx([s for _, s in best], rel=1e-9)


@pytest.mark.parametrize("shard_docs, query_block", [(bm25.SHARD_DOCS, 1024), (40, 3)])
def test_equals_the_scores_of_all(spark, monkeypatch, shard_docs, query_block):
    monkeypatch.setattr(bm25, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(bm25, "BLOCK_DOCS", 4)
    rng = random.Random(6)
    rows = [(n, prose(rng, rng.randint(1, 60), 40)) for n in range(400)]
    rows += [(400 + n, rows[50][1]) for n in range(15)]
    docs = documents(spark, rows).repartition(3)
    found = bm25.top_documents(docs, bm25.every_nth(docs), query_block=query_block)
    compare(found.collect(), brute(rows))


def test_blocks_below_the_best_are_skipped():
    import numpy as np

    texts = [np.array([7] * 20 + [1], dtype=np.uint64)] * 4
    texts += [np.array([7] + [2] * 200, dtype=np.uint64)] * 400
    row = bm25._shard(list(range(404)), texts).to_pylist()[0]
    shard = bm25.Shard(row, 100.0)
    ids, scores = shard.search(np.array([7], dtype=np.uint64), np.array([1.0]), 4)
    assert ids == [0, 1, 2, 3] and len(set(scores)) == 1


def test_odd_input(spark):
    docs = odd_documents(spark)
    rows = [(row.doc_id, row.text) for row in docs.collect()]
    assert brute(rows) == {}
    assert bm25.top_documents(docs, bm25.every_nth(docs)).collect() == []
    found = bm25.top_documents(docs, docs.where("doc_id = 5").limit(1))
    assert [row.doc_id for row in sorted(found.collect(), key=lambda r: r["rank"])] == [5, 5, 6]
    wide = with_clashes(docs)
    again = bm25.top_documents(wide, wide.where("doc_id = 5").limit(1))
    assert collected(again) == collected(found)
    assert bm25.top_documents(empty(spark), empty(spark)).collect() == []
    assert bm25.top_documents(docs, empty(spark)).collect() == []


def test_shards_share_the_score_that_is_needed(spark, monkeypatch):
    monkeypatch.setattr(bm25, "SHARD_DOCS", 20)
    monkeypatch.setattr(bm25, "FIRST", 2, raising=False)
    rng = random.Random(8)
    rows = [(n, prose(rng, rng.randint(20, 40), 40)) for n in range(400)]
    # Each query has copies in all shards; without them the best score would not tell much.
    rows = [(n, rows[n % 10 * 40][1] if n % 4 == 0 else text) for n, text in rows]
    kept, stored = [], bm25.stored

    def spy(df, purpose):
        out = stored(df, purpose)
        if purpose == "bm25-found":
            kept.append(out.count())
        return out

    monkeypatch.setattr(bm25, "stored", spy)
    docs = documents(spark, rows).repartition(4)
    found = bm25.top_documents(docs, bm25.every_nth(docs), k=3)
    compare(found.collect(), brute(rows, 3))
    queries, shards = 8, 20
    assert sum(kept) < queries * shards * 3 / 2


@pytest.mark.parametrize("left_out", [0, 0.25])
def test_needed_scores_leave_out_terms_and_no_document(monkeypatch, left_out):
    import numpy as np

    monkeypatch.setattr(bm25, "BLOCK_DOCS", 4)
    monkeypatch.setattr(bm25, "DENSE_TERMS", 3)
    monkeypatch.setattr(bm25, "MIDDLE_DOCS", 2)
    monkeypatch.setattr(bm25, "LEFT_OUT", left_out)
    rng = np.random.default_rng(4)
    texts = [rng.zipf(1.4, rng.integers(1, 60)).astype(np.uint64) % 300 for _ in range(200)]
    texts += [texts[7]] * 60 + [np.append(texts[7], n).astype(np.uint64) for n in range(500, 520)]
    shard = bm25.Shard(bm25._shard(list(range(len(texts))), texts).to_pylist()[0], 30.0)
    rows = []
    for n in range(0, len(texts), 9):
        terms = np.unique(texts[n])
        rows.append((n, terms, 1 + rng.random(len(terms)) * (terms != 1)))
    queries = bm25.Queries(rows)
    asked = {number: (terms, weights) for number, terms, weights in rows}

    def scores(terms, weights):
        out = []
        for own in texts:
            counts = collections.Counter(own.tolist())
            scale = bm25.K1 * (1 - bm25.B + bm25.B * len(own) / 30.0)
            out.append(sum(
                w * counts[t] * (bm25.K1 + 1) / (counts[t] + scale)
                for t, w in zip(terms.tolist(), weights, strict=True)
            ))
        return np.array(out)

    every = [scores(*asked[number]) for number in queries.ids.tolist()]
    for rank in (1, 5, 30):
        least = np.array([np.sort(own)[-rank] for own in every]) * (1 - 1e-12)
        for query, ids, found in shard.search_all(queries, least, 10):
            own = np.round(every[query], 9)
            best = [n for n in np.lexsort((np.arange(len(own)), -own))[:10] if own[n] > 0]
            best = [n for n in best if every[query][n] >= least[query]]
            assert ids.tolist() == best
            assert found.tolist() == pytest.approx(every[query][best].tolist(), rel=1e-9)


def test_copies_are_scored_once(monkeypatch):
    import numpy as np

    texts = [np.array([1, 2, 3], dtype=np.uint64)] * 500 + [np.array([4], dtype=np.uint64)] * 500
    shard = bm25.Shard(bm25._shard(list(range(1000)), texts).to_pylist()[0], 3.0)
    scored, scores = [], shard._scores

    def spy(docs, *rest):
        scored.append(len(docs))
        return scores(docs, *rest)

    monkeypatch.setattr(shard, "_scores", spy)
    ids, _ = shard.search(np.array([1, 2, 3], dtype=np.uint64), np.ones(3), 10)
    assert ids == list(range(10)) and scored == [1]


def test_terms_are_rows_or_postings_by_what_takes_less_time(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    # Terms up to 20 are in most documents and queries, 20 to 400 in some, the others in few.
    kinds = (range(20), range(20, 400), range(400, 40_000))
    texts = [
        np.concatenate([rng.choice(kind, 15) for kind in kinds]).astype(np.uint64)
        for _ in range(3000)
    ]
    shard = bm25.Shard(bm25._shard(list(range(3000)), texts).to_pylist()[0], 45.0)
    terms = [np.unique(own) for own in texts[:200]]
    queries = bm25.Queries([(n, own, np.ones(len(own))) for n, own in enumerate(terms)])
    cells, postings, multiply, add = [], [], shard._multiply, shard._add

    def multiplied(matrix, dense, known):
        cells.append(len(matrix) * len(dense) * known.shape[1])
        multiply(matrix, dense, known)

    def added(at, weights, of, sizes, known):
        postings.append(int(sizes.sum()) * bm25.WIDE)
        add(at, weights, of, sizes, known)

    monkeypatch.setattr(shard, "_multiply", multiplied)
    monkeypatch.setattr(shard, "_add", added)
    found = {int(queries.ids[n]): ids for n, ids, _ in shard.search_all(queries, np.zeros(200), 1)}
    assert all(ids.tolist() == [n] for n, ids in found.items()) and len(found) == 200
    have = collections.Counter(t for own in texts for t in set(own.tolist()))
    asked = collections.Counter(t for own in terms for t in own.tolist())
    by_posting = sum(asked[t] * have[t] for t in asked)
    by_cell = len(asked) * len(queries) * len(texts) * bm25.DENSE_SHARE
    took = sum(cells) * bm25.DENSE_SHARE + sum(postings)
    assert cells and postings and took < min(by_posting, by_cell) / 2


def test_queries_alike_come_together(monkeypatch):
    import numpy as np

    monkeypatch.setattr(bm25, "TOGETHER", 8)
    rng = np.random.default_rng(6)
    rows = []
    for n in range(64):
        # Two languages by turns, each with a word that nearly all texts have.
        own = rng.choice(np.arange(1, 50), rng.integers(5, 30), replace=False) + 100 * (n % 2)
        own = np.unique(np.append(own, 100 * (n % 2))).astype(np.uint64)
        rows.append((n, own, np.ones(len(own))))
    queries = bm25.Queries(rows)
    assert sorted(queries.ids.tolist()) == list(range(64))
    assert np.count_nonzero(np.diff(queries.ids % 2)) == 1
    for n, a, b in zip(queries.ids.tolist(), queries.bounds[:-1], queries.bounds[1:], strict=True):
        assert queries.terms[queries.which[a:b]].tolist() == rows[n][1].tolist()


def test_files_are_searched_in_three_parts(spark, tmp_path):
    path = str(tmp_path / "index")
    spark.range(70).repartition(70).write.parquet(path)
    index = spark.read.parquet(path)
    files = sorted(index.inputFiles())
    parts = [sorted(part.inputFiles()) for part in bm25._parts(index)]
    n = len(files)
    assert n > bm25.FIRST * bm25.AT_FIRST
    assert [len(part) for part in parts[:2]] == [-(-n // 32), -(-n // 8) - -(-n // 32)]
    assert sorted(sum(parts, [])) == files


def test_queries_of_many_words_lose_no_document():
    import numpy as np

    rng = np.random.default_rng(7)
    texts = [rng.choice(40_000, 9_000, replace=False).astype(np.uint64) for _ in range(60)]
    shard = bm25.Shard(bm25._shard(list(range(60)), texts).to_pylist()[0], 9_000.0)
    terms, weights = np.arange(40_000, dtype=np.uint64), 1e-3 + rng.random(40_000)
    every, part = weights[np.stack(texts).astype(np.int64)].sum(axis=1), (bm25.K1 + 1) / (1 + bm25.K1)
    best = np.argsort(-every)[:10]
    least = np.array([every[best[-1]] * part * (1 - 1e-12)])
    queries = bm25.Queries([(0, terms, weights)])
    ((_, ids, scores),) = shard.search_all(queries, least, 10)
    assert ids.tolist() == best.tolist()
    assert scores.tolist() == pytest.approx((every[best] * part).tolist(), rel=1e-9)
