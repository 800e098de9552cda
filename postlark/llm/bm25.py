"""Exact BM25 top-k search of texts, with block-max dynamic pruning in each index shard.

Terms are the words of a text, A-Z lower-cased, as 64-bit hashes. The index has a row for each
shard: postings sorted by term. Documents of a shard are ordered by their commonest word and
length, so that those of a block of ``BLOCK_DOCS`` are alike and block maxima are low.

A search scores some queries against a shard at once, in single precision. A term that many of
these queries and many documents have is a row of a product of matrices; the postings of the others
are added query by query. Which is chosen for these queries and this shard by what takes less time;
queries alike in words and length come together, so that they ask for the same rows.
Documents that may reach the score that a query needs are then scored exactly, in the order of
their terms. Queries that need a high score for their words leave out the terms with most postings;
block maxima bound what these can add, and only blocks that may still reach the score are looked at.

The score that a query needs is its k-th best so far. One of ``FIRST`` files of the index is
searched first, and of these one of ``AT_FIRST`` before that; the k-th best scores are sent along
with the search of the others, and each task raises them from shard to shard.

Scores use the statistics of the whole corpus: number of documents, mean length, and document
frequencies, which the shards' postings add up to. The shards' best k are merged by score and id.
The result is the exact top k.

Queries come in blocks of about ``QUERY_BLOCK``: one block is broadcast at a time, and each runs
over all shards. A query counts each of its words once. Each query meets each shard, so the work
grows with queries times documents; memory does not, as one block meets one shard at a time.

Edge cases: a text without words is in no result, and a query without words has none. Ties go to
the smaller id. Rows with the same id and text are separate results. Rows with a null id take no part. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlark.llm import words
from postlark.llm.rows import release, small_batches
from postlark.session import stored

K1 = 1.2
B = 0.75
TOP = 10
EVERY = 50
SHARD_DOCS = 8192
BLOCK_DOCS = 128
QUERY_BLOCK = 8192
# Postings of terms in so many documents of a shard, or more, are added so many at a time.
MANY_DOCS, WIDE = 8, 4
# At most so many terms are rows of a product. To add a posting takes as long as 1 / DENSE_SHARE of
# its cells.
DENSE_TERMS, DENSE_SHARE = 1024, 1 / 300
# Queries that are looked at together; postings that are added, and candidates scored, at once.
TOGETHER, ADDED, SCORED = 512, 16384, 64
# Queries are split in halves so often, each time by one of so many terms, to bring like ones together.
SPLITS, SPLIT_TERMS = 3, 1024
# One of so many files of the index is searched before the others, and of these one of so many.
FIRST, AT_FIRST = 8, 4
# A term with fewer postings in a shard is never left out.
MIDDLE_DOCS = 64
LEFT_OUT = 0.25
# Sums of single precision are off by less than 1 in 60,000, those of many terms by this for each.
SLACK, ROUNDING = 1 - 1e-4, 2.0**-22

_INDEX = "n_docs bigint, n_words bigint, ids binary, lengths binary, terms binary, " \
    "bounds binary, docs binary, tfs binary"


def term_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts as (first row, term hashes, bounds of each text)."""
    for first, buf, offsets in words.chunks(texts):
        low = words.LOWER[buf]
        rows, starts, ends = words.word_spans(low, offsets)
        yield first, words.span_hashes(low, starts, ends), np.searchsorted(
            rows, np.arange(len(offsets))
        )


def _shard(ids: list[int], texts: list[np.ndarray]) -> pa.RecordBatch:
    """The postings of some documents."""
    counted = [np.unique(own, return_counts=True) for own in texts]
    commonest = [terms[tfs.argmax()] if len(terms) else np.uint64(0) for terms, tfs in counted]
    lengths = np.array([len(own) for own in texts], dtype=np.int64)
    order = np.lexsort((np.array(ids), lengths, np.array(commonest, dtype=np.uint64)))
    sizes = np.array([len(terms) for terms, _ in counted], dtype=np.int64)[order]
    tfs = np.concatenate([np.empty(0, np.int32), *[counted[i][1].astype(np.int32) for i in order]])
    every = np.concatenate([np.empty(0, dtype=np.uint64), *[counted[i][0] for i in order]])
    del counted
    by_term = np.argsort(every, kind="stable")
    every, tfs = every[by_term], tfs[by_term]
    docs = np.repeat(np.arange(len(order), dtype=np.uint16), sizes)[by_term]
    bounds = np.flatnonzero(np.append(True, every[1:] != every[:-1])[: len(every)])
    arrays = (
        np.array(ids, dtype=np.int64)[order],
        lengths[order],
        every[bounds],
        np.append(bounds, len(every)).astype(np.int64),
        docs,
        tfs,
    )
    return pa.RecordBatch.from_arrays(
        [pa.array([len(ids)], pa.int64()), pa.array([int(lengths.sum())], pa.int64())]
        + [pa.array([a.tobytes()], pa.binary()) for a in arrays],
        names=[part.split()[0] for part in _INDEX.split(", ")],
    )


def build_index(docs: DataFrame) -> DataFrame:
    """The index: each task makes a shard of every ``SHARD_DOCS`` documents that it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        texts: list[np.ndarray] = []
        for batch in batches:
            own = batch.column(0).to_pylist()
            for first, hashes, bounds in term_hashes(batch.column(1)):
                for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    ids.append(own[first + i])
                    texts.append(hashes[a:b])
                    if len(ids) == SHARD_DOCS:
                        shard = _shard(ids, texts)
                        ids, texts = [], []
                        release()
                        yield shard
        if ids:
            shard = _shard(ids, texts)
            del ids, texts
            yield shard
            del shard
        release()

    known = docs.select(F.col("doc_id").cast("bigint"), "text").where("doc_id IS NOT NULL")
    with small_batches(docs.sparkSession):
        return stored(known.mapInArrow(run, _INDEX), "bm25-index")


def document_frequencies(index: DataFrame) -> DataFrame:
    """``term`` and the number of documents that have it, in the whole index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, bounds in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                sizes = np.diff(np.frombuffer(bounds, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(terms, dtype=np.int64)), pa.array(sizes)],
                    names=["term", "df"],
                )

    rows = index.select("terms", "bounds").mapInArrow(run, "term bigint, df bigint")
    return rows.groupBy("term").agg(F.sum("df").alias("df"))


def query_terms(docs: DataFrame) -> DataFrame:
    """``query_id`` and each distinct ``term`` of every query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, bounds in term_hashes(batch.column(1)):
                own = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                at = np.repeat(first + np.arange(len(own)), [len(terms) for terms in own])
                terms = np.concatenate([np.empty(0, dtype=np.uint64), *own]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(terms)],
                    names=["query_id", "term"],
                )

    known = docs.select(F.col("doc_id").cast("bigint"), "text").where("doc_id IS NOT NULL")
    return known.mapInArrow(run, "query_id bigint, term bigint").distinct()


class Shard:
    """A shard of the index, ready for searches with the corpus's mean length."""

    def __init__(self, row: dict, mean_length: float):
        read = np.frombuffer
        self.ids, lengths = read(row["ids"], np.int64), read(row["lengths"], np.int64)
        self.terms = read(row["terms"], np.int64).view(np.uint64)
        self.bounds, self.docs = read(row["bounds"], np.int64), read(row["docs"], np.uint16)
        self.sizes = np.diff(self.bounds)
        # Exact parts of the scores, by term and document.
        tfs = read(row["tfs"], np.int32)
        scale = K1 * (1 - B + B * lengths / mean_length)
        self.parts, scale = tfs * (K1 + 1), scale.take(self.docs)
        scale += tfs
        self.parts /= scale
        del scale
        # Postings of terms of many documents in single precision, WIDE at a time: document, part.
        many = np.flatnonzero(self.sizes >= MANY_DOCS)
        sizes = self.sizes[many]
        self.wide_sizes = np.zeros(len(self.terms), dtype=np.int64)
        self.wide_sizes[many] = -(-sizes // WIDE)
        self.wide_starts = np.cumsum(self.wide_sizes) - self.wide_sizes
        places = np.repeat(self.wide_starts[many] * WIDE - (np.cumsum(sizes) - sizes), sizes)
        places += np.arange(len(places))
        own = np.repeat(self.sizes >= MANY_DOCS, self.sizes)
        wide = np.zeros((int(self.wide_sizes.sum()) * WIDE, 2), dtype=np.int32)
        wide[places, 0] = self.docs[own]
        wide.view(np.float32)[places, 1] = self.parts[own]
        self.wide = wide.view(np.int64).reshape(-1, WIDE)

    @functools.cached_property
    def most(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The most that terms with many postings add in each block, by weight, and in all.

        First the rows of the terms, -1 for others.
        """
        blocks = -(-len(self.ids) // BLOCK_DOCS)
        terms = np.flatnonzero(self.sizes >= MIDDLE_DOCS)
        rows = np.full(len(self.terms), -1, dtype=np.int32)
        rows[terms] = np.arange(len(terms))
        postings, which = _ranges(self.bounds[terms], self.bounds[terms + 1])
        most = np.zeros((len(terms), blocks), dtype=np.float32)
        which *= blocks
        which += self.docs[postings] // BLOCK_DOCS
        np.maximum.at(most.reshape(-1), which, self.parts[postings].astype(np.float32))
        return rows, most, most.max(axis=1, initial=0)

    @functools.cached_property
    def by_doc(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Postings by document and term: their terms, their places, and each document's first."""
        order = np.argsort(self.docs, kind="stable").astype(np.int32)
        terms = np.repeat(np.arange(len(self.terms), dtype=np.int32), self.sizes)[order]
        counts = np.bincount(self.docs, minlength=len(self.ids))
        return terms, order, np.append(0, np.cumsum(counts))

    def places(self, terms: np.ndarray) -> np.ndarray:
        """The numbers of terms in this shard, -1 if not in it."""
        if not len(self.terms):
            return np.full(len(terms), -1, dtype=np.int64)
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == terms, at, -1)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[list, list]:
        """Ids and scores of the best ``k`` documents that share a term with the query."""
        queries = Queries([(0, terms, weights)])
        (_, ids, scores), = self.search_all(queries, np.zeros(1), k)
        return ids.tolist(), scores.tolist()

    def search_all(
        self, queries: Queries, least: np.ndarray, k: int
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its number, and ids and scores of its best ``k`` documents.

        Only documents that share a term with it, and score at least its value in ``least``.
        """
        places = self.places(queries.terms)
        for first in range(0, len(queries), TOGETHER):
            end = min(first + TOGETHER, len(queries))
            own = slice(queries.bounds[first], queries.bounds[end])
            at, weights = places[queries.which[own]], queries.weights[own]
            of = np.repeat(np.arange(end - first), np.diff(queries.bounds[first : end + 1]))
            at, weights, of = _where(at >= 0, at, weights, of)
            found, ids, scores = self._best(at, weights, of, least[first:end], k)
            bounds = np.searchsorted(found, np.arange(end - first + 1)).tolist()
            for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                yield first + i, ids[a:b], scores[a:b]

    def _best(
        self, at: np.ndarray, weights: np.ndarray, of: np.ndarray, least: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, id and score of the best documents of some queries, given all their terms."""
        if not len(at):
            return of, at, weights
        limits = self._leave_out(at, weights, of, least)
        used = np.ones(len(at), dtype=bool)
        for left, _ in limits.values():
            used[left] = False
        own = _taken(np.flatnonzero(used), at, weights.astype(np.float32), of)
        known = self._sums(*own, len(least))
        for query, (_, most) in limits.items():
            known[query] += np.repeat(most, BLOCK_DOCS)[: len(self.ids)]
        slack = 1 - np.maximum(1 - SLACK, np.bincount(of, minlength=len(least)) * ROUNDING)
        need = np.maximum(least * slack, np.finfo(np.float32).tiny).astype(np.float32)
        may = known >= need[:, None]
        for query in np.flatnonzero(np.count_nonzero(may, axis=1) > 4 * k).tolist():
            if query not in limits:
                # What is known of the scores so far raises the score that is needed.
                best = np.partition(known[query], len(self.ids) - k)[len(self.ids) - k]
                may[query] = known[query] >= max(need[query], best * slack[query])
        query, docs = np.divmod(np.flatnonzero(may), len(self.ids))
        del known, may
        if len(docs) > 4 * k * len(least):
            # Many documents with the same words: score one of each kind.
            pairs = np.stack([query.astype(np.uint64), self.kinds[docs]])
            _, one, kind = np.unique(pairs, axis=1, return_index=True, return_inverse=True)
        else:
            one = kind = np.arange(len(docs))
        scores = self._scores(docs[one], query[one], at, weights, of, len(least))[kind.reshape(-1)]
        ids = self.ids[docs]
        query, ids, scores = _where((scores > 0) & (scores >= least[query]), query, ids, scores)
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        return tuple(_where(rank < k, query, ids, scores))

    def _leave_out(
        self, at: np.ndarray, weights: np.ndarray, of: np.ndarray, least: np.ndarray
    ) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By query, which terms to leave out, and the most they add in each block.

        Where only documents much like the query can score so high, those with most postings are
        left out, as far as all of them cannot lift a document by what is to spare.
        """
        out = {}
        spare = least - LEFT_OUT * (K1 + 1) * np.bincount(of, weights, minlength=len(least))
        bounds = np.searchsorted(of, np.arange(len(least) + 1))
        for query in np.flatnonzero(spare > 0).tolist():
            rows, most, most_of_all = self.most
            terms = at[bounds[query] : bounds[query + 1]]
            left = np.flatnonzero(rows.take(terms) >= 0)
            left = left[np.argsort(-self.sizes.take(terms[left]), kind="stable")]
            own, row = left + bounds[query], rows.take(terms[left])
            gains = np.cumsum(weights[own] * most_of_all[row])
            end = int(np.searchsorted(gains, spare[query], side="right"))
            if end:
                out[query] = own[:end], weights[own[:end]] @ most[row[:end]]
        return out

    def _sums(
        self, at: np.ndarray, weights: np.ndarray, of: np.ndarray, queries: int
    ) -> np.ndarray:
        """Sums over some terms in single precision, by query and document."""
        known = np.zeros((queries, len(self.ids)), dtype=np.float32)
        # A term is a row of the product where that takes less time than its postings do.
        asked = np.bincount(at, minlength=len(self.terms))
        gain = asked * self.wide_sizes
        gain -= int(queries * len(self.ids) * DENSE_SHARE) // WIDE
        dense = np.flatnonzero(gain > 0)
        if len(dense) > DENSE_TERMS:
            dense = dense[np.argpartition(-gain[dense], DENSE_TERMS)[:DENSE_TERMS]]
        row = np.full(len(self.terms), -1, dtype=np.int32)
        row[dense] = np.arange(len(dense))
        row = row.take(at)
        if len(dense):
            some = np.flatnonzero(row >= 0)
            matrix = np.zeros((queries, len(dense)), dtype=np.float32)
            matrix[of.take(some), row.take(some)] = weights.take(some)
            self._multiply(matrix, dense, known)
        at, weights, of = _taken(np.flatnonzero(row < 0), at, weights, of)
        sizes = self.wide_sizes.take(at)
        self._add(*_taken(np.flatnonzero(sizes), at, weights, of, sizes), known)
        at, weights, of = _taken(np.flatnonzero(sizes == 0), at, weights, of)
        postings, which = _ranges(self.bounds.take(at), self.bounds.take(at + 1))
        cells = (of * len(self.ids)).take(which)
        cells += self.docs.take(postings)
        parts = self.parts.take(postings).astype(np.float32)
        parts *= weights.take(which)
        np.add.at(known.reshape(-1), cells, parts)
        return known

    def _multiply(self, matrix: np.ndarray, dense: np.ndarray, known: np.ndarray) -> None:
        """The product of the queries' weights with the postings of some terms."""
        postings, which = _ranges(self.bounds[dense], self.bounds[dense + 1])
        which *= len(self.ids)
        which += self.docs.take(postings)
        parts = np.zeros((len(dense), len(self.ids)), dtype=np.float32)
        parts.reshape(-1)[which] = self.parts.take(postings)
        own = np.flatnonzero(matrix.any(axis=1))
        if 2 * len(own) > len(known):
            np.matmul(matrix, parts, out=known)
        else:
            known[own] = matrix[own] @ parts

    def _add(
        self, at: np.ndarray, weights: np.ndarray, of: np.ndarray, sizes: np.ndarray,
        known: np.ndarray,
    ) -> None:
        """Add the postings of terms of many documents, some queries at a time."""
        n, flat, first = len(self.ids), known.reshape(-1), 0
        before = np.append(0, np.cumsum(sizes))
        starts = self.wide_starts.take(at)
        starts -= before[:-1]
        bounds = np.searchsorted(of, np.arange(len(known) + 1))
        ends = before[bounds]
        while first < len(known):
            end = int(np.searchsorted(ends, ends[first] + ADDED // WIDE, side="right")) - 1
            end = max(first + 1, end)
            a, b = bounds[first], bounds[end]
            if a < b:
                own = sizes[a:b]
                places = np.repeat(starts[a:b], own)
                places += np.arange(before[a], before[b])
                own = own * WIDE
                cells = self.wide.take(places, axis=0).reshape(-1)
                parts = np.repeat(weights[a:b], own)
                parts *= cells.view(np.float32)[1::2]
                cells &= 0xFFFF
                if end > first + 1:
                    cells += np.repeat((of[a:b] - first) * n, own)
                np.add.at(flat[first * n : end * n], cells, parts)
            first = end

    def _scores(
        self, docs: np.ndarray, query: np.ndarray, at: np.ndarray, weights: np.ndarray,
        of: np.ndarray, queries: int,
    ) -> np.ndarray:
        """Exact scores of documents for queries, each summed in the order of its terms."""
        bounds, out = np.searchsorted(of, np.arange(queries + 1)), np.empty(len(docs))
        if not len(docs):
            return out
        terms, postings, firsts = self.by_doc
        by_doc = np.argsort(docs, kind="stable")
        runs = np.append(np.flatnonzero(np.diff(docs[by_doc], prepend=-1)), len(docs)).tolist()
        parts = np.zeros(len(self.terms))
        for a, b in zip(runs[:-1], runs[1:], strict=True):
            doc = docs[by_doc[a]]
            own = slice(firsts[doc], firsts[doc + 1])
            parts[terms[own]] = self.parts[postings[own]]
            for first in range(a, b, SCORED):
                some = by_doc[first : min(first + SCORED, b)]
                asked, which = _ranges(bounds[query[some]], bounds[query[some] + 1])
                # Terms that the document does not have add 0.
                out[some] = np.bincount(which, weights[asked] * parts[at[asked]], len(some))
            parts[terms[own]] = 0
        return out

    @functools.cached_property
    def kinds(self) -> np.ndarray:
        """A number for each document, the same for those with the same words, as often."""
        terms, postings, firsts = self.by_doc
        kinds = words.mix(words.mix(self.terms)[terms] + self.parts[postings].view(np.uint64))
        sums = np.append(np.uint64(0), np.cumsum(kinds))
        return sums[firsts[1:]] - sums[firsts[:-1]]


class Queries:
    """Some queries: their ids, all distinct terms, and of each query its terms and weights."""

    def __init__(self, rows: list[tuple[int, np.ndarray, np.ndarray]]):
        rows = [rows[i] for i in _alike([terms for _, terms, _ in rows])]
        self.ids = np.array([query for query, _, _ in rows], dtype=np.int64)
        self.bounds = np.append(0, np.cumsum([len(terms) for _, terms, _ in rows])).astype(np.int64)
        terms = np.concatenate([np.empty(0, dtype=np.uint64), *[terms for _, terms, _ in rows]])
        self.terms, which = np.unique(terms, return_inverse=True)
        self.which = which.astype(np.int32)
        self.weights = np.concatenate([np.empty(0), *[weights for _, _, weights in rows]])

    def __len__(self) -> int:
        return len(self.ids)


def _alike(rows: list[np.ndarray]) -> np.ndarray:
    """An order of sets of terms in which those of like words and like size come together.

    All are split by the term that is nearest to being in half of them, and each half again.
    """
    sizes = np.array([len(terms) for terms in rows], dtype=np.int64)
    every = np.concatenate([np.empty(0, dtype=np.uint64), *rows])
    terms, which, counts = np.unique(every, return_inverse=True, return_counts=True)
    common = np.argsort(-counts, kind="stable")[:SPLIT_TERMS]
    number = np.full(len(terms), -1)
    number[common] = np.arange(len(common))
    number, of = number[which], np.repeat(np.arange(len(rows)), sizes)
    has = np.zeros((len(common), len(rows)), dtype=bool)
    has[number[number >= 0], of[number >= 0]] = True
    parts = [np.arange(len(rows))]
    for _ in range(SPLITS):
        parts = [half for own in parts for half in _halves(has, own) if len(half)]
    group = np.empty(len(rows), dtype=np.int64)
    for i, own in enumerate(parts):
        group[own] = i
    return np.lexsort((sizes, group))


def _halves(has: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, ...]:
    if len(own) < TOGETHER or not len(has):
        return (own,)
    shares = has[:, own].mean(axis=1)
    split = has[np.abs(shares - 0.5).argmin(), own]
    return own[split], own[~split]


def _where(chosen: np.ndarray, *arrays: np.ndarray) -> list[np.ndarray]:
    return [array[chosen] for array in arrays]


def _taken(places: np.ndarray, *arrays: np.ndarray) -> list[np.ndarray]:
    return [array.take(places) for array in arrays]


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges, one after the other, and the range of each."""
    sizes = ends - starts
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(owner)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes), owner


def top_documents(
    docs: DataFrame, queries: DataFrame, k: int = TOP, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """``query_id``, ``rank``, ``doc_id`` and ``score`` of the best ``k`` texts of each query."""
    context = docs.sparkSession.sparkContext
    index = build_index(docs)
    n_docs, n_words = index.agg(F.sum("n_docs"), F.sum("n_words")).first()
    n_docs, mean_length = n_docs or 0, max((n_words or 0) / max(n_docs or 0, 1), 1e-9)
    idf = F.log1p((F.lit(float(n_docs)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    asked = query_terms(queries).join(document_frequencies(index), "term")
    asked = asked.withColumn("weight", idf).groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("terms")
    )
    with small_batches(docs.sparkSession, 100):
        asked = stored(asked.select("query_id", "terms"), "bm25-queries")
    blocks = max(1, -(-asked.count() // query_block))
    placed = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    parts = _parts(index)
    found = None
    for block in range(blocks):
        # About ``query_block`` queries.
        queries = _packed(placed.where(F.col("block") == block))
        least, so_far = np.zeros(len(queries)), None
        shared = context.broadcast(queries)
        for part in parts:
            with small_batches(docs.sparkSession, 1):
                own = stored(_searched(part, shared, least, mean_length, k), "bm25-found")
            so_far = own if so_far is None else so_far.unionByName(own)
            if part is not parts[-1]:
                least = _least(so_far, queries, k)
        shared.unpersist()
        found = so_far if found is None else found.unionByName(so_far)
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)


def _parts(index: DataFrame) -> list[DataFrame]:
    """The index in parts to be searched one after the other.

    One of ``FIRST`` files comes before the others, and of these files one of ``AT_FIRST``.
    """
    files = sorted(index.inputFiles())
    if len(files) < FIRST:
        return [index]
    earliest, first = files[:: FIRST * AT_FIRST], files[::FIRST]
    parts = (
        earliest,
        [file for file in first if file not in earliest],
        [file for i, file in enumerate(files) if i % FIRST],
    )
    read = index.sparkSession.read.schema(index.schema)
    return [read.parquet(*part) for part in parts if part]


def _least(found: DataFrame, queries: Queries, k: int) -> np.ndarray:
    """For each query the ``k``-th best score so far, 0 if there is none."""
    scores = F.sort_array(F.collect_list("score"), asc=False)
    best = found.groupBy("query_id").agg(scores.alias("scores")).where(F.size("scores") >= k)
    rows = best.select("query_id", F.col("scores")[k - 1].alias("least")).toArrow()
    least = np.zeros(len(queries))
    order = np.argsort(queries.ids)
    places = np.searchsorted(queries.ids, rows["query_id"].to_numpy(), sorter=order)
    least[order[places]] = rows["least"].to_numpy()
    return least


def _packed(queries: DataFrame) -> Queries:
    rows = queries.select(
        "query_id", F.col("terms.term").alias("terms"), F.col("terms.weight").alias("weights")
    ).toArrow()
    out = []
    for batch in rows.to_batches():
        ids, terms, weights = batch.columns
        bounds = np.append(0, np.cumsum(pc.list_value_length(terms).to_numpy()))
        terms = terms.flatten().to_numpy().view(np.uint64)
        weights = weights.flatten().to_numpy()
        out += [
            (query, terms[a:b], weights[a:b])
            for query, a, b in zip(ids.to_pylist(), bounds[:-1], bounds[1:], strict=True)
        ]
    return Queries(out)


def _searched(
    index: DataFrame, shared, least: np.ndarray, mean_length: float, k: int
) -> DataFrame:
    """Documents of the index that may be among the best ``k`` of all, with their scores.

    A task raises the score that a query needs from shard to shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, need = shared.value, least.copy()
        best = np.zeros((len(queries), k))
        for batch in batches:
            for at in range(len(batch)):
                # The columns are read where they lie, which saves a copy of the shard.
                row = {name: batch[name][at].as_buffer() for name in batch.schema.names[2:]}
                shard = Shard(row, mean_length)
                found = []
                for query, ids, scores in shard.search_all(queries, need, k):
                    if len(ids):
                        found.append((np.full(len(ids), queries.ids[query]), ids, scores))
                        best[query] = np.sort(np.append(best[query], scores))[-k:]
                        need[query] = max(need[query], best[query, 0])
                if found:
                    columns = [np.concatenate(column) for column in zip(*found, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(column) for column in columns],
                        names=["query_id", "doc_id", "score"],
                    )
                del shard, found, row
            del batch
            release()

    return index.mapInArrow(run, "query_id bigint, doc_id bigint, score double")


def every_nth(docs: DataFrame, n: int = EVERY) -> DataFrame:
    """The stated query set: the rows whose id is divisible by ``n``."""
    return docs.where(F.col("doc_id") % n == 0)
