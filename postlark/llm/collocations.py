"""Phrase collocations of each language, mined by best-first branch and bound.

A phrase of two or three words is a candidate if it occurs ``min_count`` times within pieces of
text. Its score is ``floor(10^6 a^2 / (l r))``, ``a`` being its count and ``l`` and ``r`` those of the
two parts of the cut that scores lowest. A candidate is dropped if a longer one that contains it has
``drop_percent`` of its count.

Phrases grow from prefixes. A phrase occurs no more often than its prefix, and the rest behind its
first word no less often than the phrase, so no phrase that grows from a prefix ``x y`` scores more
than ``floor(10^6 f(x y) / f(x))``. This bound orders the frontier: of each language the prefixes are
expanded whose bound reaches a threshold, and the pairs whose own score reaches it are looked up in
all longer phrases that may drop them. The threshold starts at the score of the pair of rank
``4 * limit``. Once ``limit`` phrases that survive have scores at or above it, no phrase outside the
frontier can be among them, ties included, and the language is settled. Otherwise its frontier
grows by a factor of four, until it holds everything.

Counting: words are counted as they are written. Each gets a key, a hash of its language and itself,
and the table of words is checked to have no key twice; else other keys are taken. Longer phrases are
counted as rows of keys, added up in the task before they are shuffled, and only the best meet the
table of words again. Which phrases a task counts is read from bitmaps of hashed keys, whose size
follows the number of keys up to ``MAX_BITS``; what passes by chance is counted in full, so it does no
harm. Nothing but these bitmaps reaches the driver. Products of counts are decimals of 38 digits.

Edge cases: a null text has no words, a null language is ``und``. Equal rows count each. An empty table
gives an empty result, other columns are ignored. A text of any length is taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlark.llm.rows import release, small_batches
from postlark.llm.sieve import passes, sieve
from postlark.llm.words import LOWER, chunks, mix, span_hashes
from postlark.session import discard, stored

MIN_COUNT = 10
DROP_PERCENT = 50
LIMIT = 2000
SCALE = 1_000_000

# The first frontier of a language has pairs down to this many times the limit, and each further
# one as many times as many.
GROWTH = 4

# Largest size of a bitmap, in bits: 2 ** 28 bits are 32 MB.
MIN_BITS, MAX_BITS = 16, 28

# What ends a piece, and what else ends a word.
_PIECE_ENDS = np.zeros(256, dtype=bool)
_PIECE_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD_ENDS = _PIECE_ENDS.copy()
_WORD_ENDS[[0x09, 0x20]] = True

_LANG = "und"

# Phrases that a task holds before it adds them up, the number of sums sent at a time, and the bytes of
# text taken at a time.
_HELD, _SENT, _CHUNK_BYTES = 1 << 18, 1 << 15, 1 << 19

_STEP = np.uint64(0x9E3779B97F4A7C55)


def _string_hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string."""
    out = np.zeros(len(strings), dtype=np.uint64)
    for first, buf, offsets in chunks(strings):
        out[first : first + len(offsets) - 1] = span_hashes(buf, offsets[:-1], offsets[1:])
    return out


def _word_keys(langs: np.ndarray, words: np.ndarray, seed: int) -> np.ndarray:
    """Keys of words from the hashes of their language and themselves."""
    return mix(mix(langs + np.uint64(seed)) * _STEP + words)


def _pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first.view(np.uint64) * _STEP + second.view(np.uint64)).view(np.int64)


def _added(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of some columns with the sums of ``n``."""
    order = np.lexsort(columns[::-1])
    columns, n = [c[order] for c in columns], n[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.add.reduceat(n, first) if len(first) else n


def _bits(keys: DataFrame) -> int:
    """The size of a bitmap: about sixteen bits a key, within limits."""
    return min(max(keys.count().bit_length() + 4, MIN_BITS), MAX_BITS)


def _pair_bitmap(pairs: DataFrame) -> bytes:
    return sieve(
        pairs.select("k1", "k2"),
        _bits(pairs),
        lambda batch: _pair_keys(batch.column(0).to_numpy(), batch.column(1).to_numpy()),
    )


def _spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end, row and piece of every word."""
    inside = ~_WORD_ENDS[buf]
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[offsets] = True
    before = np.ones(len(buf), dtype=bool)
    before[1:] = ~inside[:-1]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    after = np.ones(len(buf), dtype=bool)
    after[:-1] = ~inside[1:]
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    breaks = np.cumsum(_PIECE_ENDS[buf], dtype=np.int64)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows, breaks[starts] + rows


class _Chunk:
    """The words of some texts."""

    def __init__(self, langs: pa.Array, buf: np.ndarray, offsets: np.ndarray):
        self.buf = LOWER[buf]
        self.starts, self.ends, self.rows, self.pieces = _spans(self.buf, offsets)
        self.langs = langs.dictionary_encode()
        self.lang_of = self.langs.indices.to_numpy()[self.rows]

    def within_pieces(self, size: int) -> np.ndarray:
        """Whether a phrase of some words starts at each word but the last ones."""
        n = max(len(self.starts) - size + 1, 0)
        return self.pieces[:n] == self.pieces[len(self.pieces) - n :]

    def words(self) -> pa.DictionaryArray:
        sizes = self.ends - self.starts
        bounds = np.zeros(len(sizes) + 1, dtype=np.int64)
        np.cumsum(sizes, out=bounds[1:])
        packed = np.ascontiguousarray(self.buf[~_WORD_ENDS[self.buf]])
        array = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(packed)]
        )
        return array.dictionary_encode()

    def keys(self, seed: int) -> np.ndarray:
        """The key of every word."""
        langs = _string_hashes(self.langs.dictionary)[self.lang_of]
        words = span_hashes(self.buf, self.starts, self.ends)
        return _word_keys(langs, words, seed).view(np.int64)


def _with_lang(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit(_LANG)).alias("lang"), "text")


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunk]:
    for batch in batches:
        for first, buf, offsets in chunks(batch.column(1), _CHUNK_BYTES):
            yield _Chunk(batch.column(0).slice(first, len(offsets) - 1), buf, offsets)


def _sent(names: list[str], columns: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    """Rows a part at a time, so that they take little room on their way."""
    batch = pa.RecordBatch.from_arrays(columns, names=names)
    for first in range(0, batch.num_rows, _SENT):
        yield batch.slice(first, _SENT)


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``word``, ``n`` of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def combined() -> pa.Table:
            sums = pa.concat_tables(held).group_by(["lang", "word"]).aggregate([("n", "sum")])
            return sums.rename_columns(["lang", "word", "n"])

        for chunk in _chunked(batches):
            coded = chunk.words()
            (langs, codes), n = _added(
                [chunk.lang_of.astype(np.int64), coded.indices.to_numpy().astype(np.int64)],
                np.ones(len(coded), dtype=np.int64),
            )
            columns = [
                chunk.langs.dictionary.take(pa.array(langs)),
                coded.dictionary.cast(pa.large_string()).take(pa.array(codes)).cast(pa.string()),
                pa.array(n),
            ]
            held.append(pa.table(columns, names=["lang", "word", "n"]))
            if sum(table.num_rows for table in held) >= _HELD:
                held = [combined()]
                if held[0].num_rows >= _HELD // 2:
                    yield from held.pop().to_batches(max_chunksize=_SENT)
        if held:
            yield from combined().to_batches(max_chunksize=_SENT)
        held.clear()
        release()

    partial = _with_lang(docs).mapInArrow(run, "lang string, word string, n bigint")
    return _summed(partial, "lang", "word")


def _summed(partial: DataFrame, *keys: str) -> DataFrame:
    """Sums by key. Tasks have added up already, so rows are dealt by key before they are added."""
    return partial.repartition(*keys).groupBy(*keys).agg(F.sum("n").alias("n"))


def keyed(words: DataFrame, seed: int = 0) -> DataFrame:
    """Add the key of each word in ``k``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_string_hashes(batch.column(i)) for i in range(2)]
            keys = pa.array(_word_keys(*parts, seed).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=["lang", "word", "n", "k"])

    return words.select("lang", "word", "n").mapInArrow(
        run, "lang string, word string, n bigint, k bigint"
    )


def _key_table(docs: DataFrame) -> tuple[DataFrame, int]:
    """All words with keys of their own, and the seed of the keys."""
    counted = stored(word_counts(docs), "phrase-words")
    seed = 0
    while True:
        words = stored(keyed(counted, seed), "phrase-keys")
        if words.groupBy("k").count().where("count > 1").isEmpty():
            discard(counted)
            return words, seed
        discard(words)
        seed += 1


def phrase_counts(
    docs: DataFrame, size: int, seed: int, words: bytes | None = None, pairs: tuple[bytes, ...] = ()
) -> DataFrame:
    """The keys of each phrase of ``size`` words, ``k1`` and so on, and its count ``n``.

    With ``words``, only phrases of words in that bitmap are counted. With ``pairs``, three
    bitmaps, only phrases of three words: both pairs are in the first one, and the first pair in the
    second or the last pair in the third.
    """
    # Bitmaps of at most ``2 ** MAX_BITS`` bits each.
    shared = docs.sparkSession.sparkContext.broadcast((words, pairs))
    names = [f"k{i + 1}" for i in range(size)]

    def found(chunk: _Chunk) -> list[np.ndarray]:
        words, pairs = shared.value
        keys = chunk.keys(seed)
        whole = chunk.within_pieces(size)
        if words:
            known = passes(keys, words)
            for i in range(size):
                whole &= known[i : i + len(whole)]
        if pairs and len(whole):
            of_two = _pair_keys(keys[:-1], keys[1:])
            common = passes(of_two, pairs[0])
            whole &= common[:-1] & common[1:]
            at = np.flatnonzero(whole)
            whole[at] = passes(of_two[at], pairs[1]) | passes(of_two[at + 1], pairs[2])
        at = np.flatnonzero(whole)
        return [keys[at + i] for i in range(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[list[np.ndarray], np.ndarray]] = []
        n = 0

        def combined() -> tuple[list[np.ndarray], np.ndarray]:
            columns = [np.concatenate([c[i] for c, _ in held]) for i in range(size)]
            return _added(columns, np.concatenate([sums for _, sums in held]))

        for chunk in _chunked(batches):
            own = found(chunk)
            held.append(_added(own, np.ones(len(own[0]), dtype=np.int64)))
            n += len(held[-1][1])
            if n >= _HELD:
                held = [combined()]
                n = len(held[0][1])
                if n >= _HELD // 2:
                    yield from _sent([*names, "n"], [*map(pa.array, held[0][0]), pa.array(held[0][1])])
                    held, n = [], 0
        if held:
            columns, sums = combined()
            yield from _sent([*names, "n"], [*map(pa.array, columns), pa.array(sums)])
            del columns, sums
        held.clear()
        release()

    schema = ", ".join(f"{name} bigint" for name in [*names, "n"])
    return _summed(_with_lang(docs).mapInArrow(run, schema), *names)


def _score(a: Column, left: Column, right: Column) -> Column:
    """``floor(10^6 a^2 / (l r))``, exactly; counts have at most fifteen digits."""
    wide = [x.cast("decimal(15,0)") for x in (a, left, right)]
    top = (wide[0] * wide[0] * F.lit(SCALE).cast("decimal(7,0)")).cast("decimal(38,0)")
    bottom = (wide[1] * wide[2]).cast("decimal(38,0)")
    return F.call_function("div", top, bottom)


def _with_count(phrases: DataFrame, counts: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Add the count of the words whose keys are in ``columns``."""
    own = [c for c in counts.columns if c.startswith("k")]
    renamed = counts.select(
        *[F.col(a).alias(b) for a, b in zip(own, columns, strict=True)], F.col("n").alias(name)
    )
    return phrases.join(renamed, columns)


def _thresholds(nodes: DataFrame, k: int) -> DataFrame:
    """``lang``, ``least``: the score of the pair of rank ``k``, or 0 if there are fewer pairs.

    Ranks come from the number of pairs of each score, at most a million and one a language.
    """
    bins = nodes.groupBy("lang", "score").agg(F.count("*").alias("size"))
    down = Window.partitionBy("lang").orderBy(F.desc("score"))
    ranked = bins.withColumn("reached", F.sum("size").over(down))
    reach = F.col("reached") - F.col("size") < k
    least = F.min(F.when(reach, F.col("score")))
    return ranked.groupBy("lang").agg(
        F.when(F.sum("size") < k, F.lit(0)).otherwise(least).cast("bigint").alias("least")
    )


def _scored_triples(triples: DataFrame, words: DataFrame, pairs: DataFrame) -> DataFrame:
    """Candidates of three words with the parts of their lowest cut and the score."""
    found = triples.withColumnRenamed("n", "a").join(
        words.select(F.col("k").alias("k1"), "lang", F.col("n").alias("l1")), "k1"
    )
    found = _with_count(found, pairs, ["k2", "k3"], "r1")
    found = _with_count(found, pairs, ["k1", "k2"], "l2")
    found = _with_count(found, words.select("k", "n"), ["k3"], "r2")
    first = F.col("s1") <= F.col("s2")
    return found.withColumns(
        {
            "s1": _score(F.col("a"), F.col("l1"), F.col("r1")),
            "s2": _score(F.col("a"), F.col("l2"), F.col("r2")),
        }
    ).select(
        "lang", "k1", "k2", "k3", "a",
        F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )


def _surviving_pairs(resolved: DataFrame, triples: DataFrame, drop_percent: int) -> DataFrame:
    """Pairs without a longer candidate around them that is frequent enough."""
    parts = [
        F.struct(F.col(a).alias("k1"), F.col(b).alias("k2")) for a, b in (("k1", "k2"), ("k2", "k3"))
    ]
    around = triples.select(F.inline(F.array(*parts)), "n")
    longest = around.groupBy("k1", "k2").agg(F.max("n").alias("longer"))
    kept = F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * drop_percent)
    return (
        resolved.join(longest, ["k1", "k2"], "left")
        .where(kept)
        .select("lang", "k1", "k2", F.lit(None).cast("bigint").alias("k3"), "a", "l", "r", "score")
    )


def _written(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Add the words of phrases, joined by spaces."""
    for i in range(1, 4):
        own = words.select(F.col("k").alias(f"k{i}"), F.col("word").alias(f"w{i}"))
        phrases = phrases.join(own, f"k{i}", "left" if i == 3 else "inner")
    return phrases.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "l", "r", "score"
    )


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    drop_percent: int = DROP_PERCENT,
    limit: int = LIMIT,
    growth: int = GROWTH,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of the best phrases.

    ``n`` is the number of words of the language. Phrases are ordered by score and count, greater
    first, then by the bytes of the phrase.
    """
    with small_batches(docs.sparkSession):
        return _collocations(docs, min_count, drop_percent, limit, growth)


def _collocations(
    docs: DataFrame, min_count: int, drop_percent: int, limit: int, growth: int
) -> DataFrame:
    spark = docs.sparkSession
    every_word, seed = _key_table(docs)
    totals = every_word.groupBy("lang").agg(F.sum("n").alias("n"))
    words = every_word.where(F.col("n") >= min_count)
    known = sieve(words.select("k"), _bits(words))
    pairs = stored(
        phrase_counts(docs, 2, seed, words=known).where(F.col("n") >= min_count), "phrases-2"
    )
    # A node of the frontier: a pair, as a candidate and as a prefix.
    scored = pairs.withColumnRenamed("n", "a").join(
        words.select(F.col("k").alias("k1"), "lang", F.col("n").alias("l")), "k1"
    )
    scored = _with_count(scored, words.select("k", "n"), ["k2"], "r")
    nodes = stored(
        scored.withColumns(
            {
                "score": _score(F.col("a"), F.col("l"), F.col("r")),
                "bound": _score(F.col("a"), F.col("a"), F.col("l")),
            }
        ),
        "phrase-nodes",
    )
    common = _pair_bitmap(nodes)
    best, left, k = [], nodes, limit * growth
    while not left.isEmpty():
        least = stored(_thresholds(left, k), "phrase-thresholds")
        open_nodes = left.join(least, "lang")
        expanded = open_nodes.where(F.col("bound") >= F.col("least"))
        resolved = open_nodes.where(F.col("score") >= F.col("least"))
        maps = (common, _pair_bitmap(expanded), _pair_bitmap(resolved))
        # Later rounds read the languages that are still open.
        unsettled = _with_lang(docs).join(least.select("lang"), "lang", "left_semi")
        triples = stored(
            phrase_counts(unsettled if best else docs, 3, seed, pairs=maps).where(
                F.col("n") >= min_count
            ),
            "phrases-3",
        )
        grown = _scored_triples(triples, words, pairs).join(least, "lang")
        surviving = stored(
            grown.where(F.col("score") >= F.col("least"))
            .drop("least")
            .unionByName(_surviving_pairs(resolved, triples, drop_percent)),
            "phrases-surviving",
        )
        reached = surviving.groupBy("lang").agg(F.count("*").alias("n"))
        settled = stored(
            least.join(reached, "lang", "left")
            .where((F.col("n") >= limit) | (F.col("least") == 0))
            .select("lang"),
            "phrases-settled",
        )
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        best.append(
            stored(
                _written(surviving.join(settled, "lang", "left_semi"), words)
                .withColumn("rank", F.row_number().over(order).cast("bigint"))
                .where(F.col("rank") <= limit),
                "phrases-best",
            )
        )
        left = left.join(settled, "lang", "left_anti")
        discard(triples, surviving)
        k *= growth
    if not best:
        schema = "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint"
        return spark.createDataFrame([], f"{schema}, score bigint")
    return (
        reduce(DataFrame.unionByName, best)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
