"""Cross-tokenizer alignment: which tokens of one vocabulary stand for which of another.

Every text is encoded by a byte-level vocabulary (A) and a vocabulary of pieces (B). The tokens of
both cover the same bytes, so each token is an interval. Intervals of many texts are sorted by
start at once, and a running maximum of their ends breaks them into groups wherever a start reaches
it: a group is a shortest stretch at whose ends tokens of both sides end. Overlapping tokens of a
group are expanded into pairs, and the pairs that the rule asks for are links.

Corpus-wide counts of linked id pairs are taken from stored pairs with weights, combined in the
task before they are shuffled. The most frequent pairs, at most ``max_pairs`` of them, are sent to
all tasks, so that common pairs cost no shuffle and make no hot key; all other pairs meet their
counts in a join. The highest count of each B id is one row an id, as many as the vocabulary has.

Edge cases: a text that is null, empty, or not covered alike by both sides (its joined tokens differ
from a space and the text) has no tokens, zeros, and empty groups. Equal rows are aligned alike and
each counts. A null id is passed on, other columns are ignored, and an empty table gives an empty
result. A text of any length is aligned whole; short texts are taken together.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlark.llm.bpe import Vocabulary, frequent
from postlark.session import discard, stored

# Bound of the broadcast table of pairs.
MAX_PAIRS = 1 << 20

# Texts are aligned together up to this many bytes, and a longer one alone.
CHUNK_BYTES = 1 << 20

# Pairs held by a task before they are combined, and distinct ones before they are sent on.
_HELD = 1 << 22
_KEPT = 1 << 20

# Fixed value: the words of the byte-level tokenizer.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

Encoder = Callable[[list[str]], list[np.ndarray]]


class ByteLevel:
    """A byte-level vocabulary file, which encodes a text with a space before it.

    Its merges are made in the order of their ids, so ids serve as ranks.
    """

    def __init__(self, path: str):
        vocabulary = Vocabulary(path)
        self.pieces = vocabulary.pieces
        self.specials = set(vocabulary.specials.values())
        model = json.loads(vocabulary.text)["model"]
        made = [
            model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)]
            for m in model["merges"]
        ]
        if any(a >= b for a, b in zip(made, made[1:], strict=False)):
            raise ValueError("the merges of this vocabulary are not in the order of its ids")

    def encoder(self) -> Encoder:
        import tiktoken

        ranks = {p: i for i, p in enumerate(self.pieces) if p and i not in self.specials}
        own = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

        def encode(texts: list[str]) -> list[np.ndarray]:
            return [np.array(own.encode_ordinary(" " + t), dtype=np.int64) for t in texts]

        return encode


class SentencePieces:
    """A vocabulary of pieces with byte fallback, which puts the space before a text itself."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.model = file.read()
        loaded = self._load()
        ids = range(loaded.get_piece_size())
        self.pieces = [
            bytes([int(loaded.id_to_piece(i)[3:-1], 16)])
            if loaded.is_byte(i)
            else loaded.id_to_piece(i).replace("▁", " ").encode()
            for i in ids
        ]

    def _load(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    def encoder(self) -> Encoder:
        loaded = self._load()

        def encode(texts: list[str]) -> list[np.ndarray]:
            return [np.array(ids, dtype=np.int64) for ids in loaded.encode(texts, num_threads=1)]

        return encode


Side = ByteLevel | SentencePieces


def _runs(texts: list[str | None], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``size`` characters."""
    first = held = 0
    for at, text in enumerate(texts):
        held += len(text or "")
        if held >= size:
            yield first, at + 1
            first, held = at + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _spans(ids: list[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts end to end, with the start and end byte of each."""
    flat = np.concatenate([np.empty(0, dtype=np.int64), *ids])
    ends = np.cumsum(sizes[flat])
    return flat, ends - sizes[flat], ends


def coalesced(
    starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of every A and of every B interval, and the number of groups."""
    n = len(starts_a)
    starts, ends = np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b])
    side = np.zeros(len(starts), dtype=np.int8)
    side[n:] = 1
    order = np.lexsort((side, starts))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), dtype=bool)
    breaks[1:] = starts[order][1:] >= reached[:-1]
    groups = np.empty(len(order), dtype=np.int64)
    groups[order] = np.cumsum(breaks) - 1
    return groups[:n], groups[n:], int(breaks.sum())


def overlaps(
    starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the A and B intervals of every pair that shares a byte."""
    first = np.searchsorted(ends_b, starts_a, side="right")
    last = np.searchsorted(starts_b, ends_a, side="left")
    sizes = np.maximum(last - first, 0)
    a = np.repeat(np.arange(len(starts_a)), sizes)
    within = np.arange(len(a)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return a, first[a] + within


class _Writer:
    """Groups as text: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, n_ids: int):
        texts = [f"{i}{mark}".encode() for mark in ",|;" for i in range(n_ids)]
        self.n_ids = n_ids
        self.bounds = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) for t in texts], out=self.bounds[1:])
        self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def write(self, a, b, groups_a, groups_b) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The text of all groups, the group of each token in it, and where each token starts."""
        ids = np.concatenate([a, b])
        marks = np.zeros(len(ids), dtype=np.int64)
        for groups, offset, mark in ((groups_a, 0, 1), (groups_b, len(a), 2)):
            last = np.flatnonzero(np.append(groups[1:] != groups[:-1], True)) if len(groups) else []
            marks[offset + np.asarray(last, dtype=np.int64)] = mark
        groups = np.concatenate([groups_a, groups_b])
        order = np.argsort(groups, kind="stable")
        rows = (marks * self.n_ids + ids)[order]
        sizes = self.bounds[rows + 1] - self.bounds[rows]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(
            ends - sizes - self.bounds[rows], sizes
        )
        return self.data[at].tobytes(), groups[order], ends - sizes


class Aligner:
    """Aligns texts in a task."""

    def __init__(self, a: Side, b: Side, link: str):
        self.a, self.b, self.link = a, b, link
        self.encode_a, self.encode_b = a.encoder(), b.encoder()
        self.sizes_a = np.array([len(p) for p in a.pieces], dtype=np.int64)
        self.sizes_b = np.array([len(p) for p in b.pieces], dtype=np.int64)
        self.writer = _Writer(max(len(a.pieces), len(b.pieces)))

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides; none for texts that they do not cover alike."""
        none = np.empty(0, dtype=np.int64)
        ids_a, ids_b = [none] * len(texts), [none] * len(texts)
        own = [i for i, text in enumerate(texts) if text]
        found_a = self.encode_a([texts[i] for i in own])
        found_b = self.encode_b([texts[i] for i in own])
        for i, x, y in zip(own, found_a, found_b, strict=True):
            whole = b" " + texts[i].encode()
            if (
                b"".join(map(self.a.pieces.__getitem__, x.tolist())) == whole
                and b"".join(map(self.b.pieces.__getitem__, y.tolist())) == whole
            ):
                ids_a[i], ids_b[i] = x, y
        return ids_a, ids_b

    def rows(self, texts: list[str | None]) -> dict[str, list]:
        """For each text its token and group counts, linked pairs with weights, and group text."""
        ids_a, ids_b = self.tokens(texts)
        a, starts_a, ends_a = _spans(ids_a, self.sizes_a)
        b, starts_b, ends_b = _spans(ids_b, self.sizes_b)
        groups_a, groups_b, n = coalesced(starts_a, ends_a, starts_b, ends_b)
        n_a = np.array([len(x) for x in ids_a], dtype=np.int64)
        n_b = np.array([len(x) for x in ids_b], dtype=np.int64)
        text_of_a = np.repeat(np.arange(len(texts)), n_a)
        # Both sides of a text end together, so no group reaches into the next text.
        n_groups = np.bincount(
            text_of_a[np.flatnonzero(np.diff(groups_a, prepend=-1))], minlength=len(texts)
        )
        at_a, at_b = overlaps(starts_a, ends_a, starts_b, ends_b)
        if self.link == "end":
            same = ends_a[at_a] == ends_b[at_b]
            at_a, at_b = at_a[same], at_b[same]
        pairs = a[at_a] * len(self.b.pieces) + b[at_b]
        n_links = np.bincount(text_of_a[at_a], minlength=len(texts))
        keys, weights = _summed(
            text_of_a[at_a] * (len(self.a.pieces) * len(self.b.pieces)) + pairs
        )
        bounds = np.searchsorted(
            keys, np.arange(len(texts) + 1) * (len(self.a.pieces) * len(self.b.pieces))
        )
        keys %= len(self.a.pieces) * len(self.b.pieces)
        written, groups, places = self.writer.write(a, b, groups_a, groups_b)
        first_group = np.cumsum(n_groups) - n_groups
        cuts = np.append(places, len(written))[np.searchsorted(groups, np.append(first_group, n))]
        hashes, packed = [], []
        for i in range(len(texts)):
            own = written[cuts[i] : cuts[i + 1]]
            hashes.append(hashlib.sha256(own[:-1]).hexdigest() if own else "")
            packed.append(_packed(keys[bounds[i] : bounds[i + 1]], weights[bounds[i] : bounds[i + 1]]))
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": n_groups,
            "n_links": n_links,
            "groups_sha256": hashes,
            "pairs": packed,
        }


def _summed(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their weights."""
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    if weights is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


# Pairs of a text are stored as steps from one to the next, then weights: small numbers, which
# the file format compresses well.
def _packed(pairs: np.ndarray, weights: np.ndarray) -> bytes:
    both = np.concatenate([np.diff(pairs, prepend=0), weights])
    return both.astype("<u4" if both.max(initial=0) < 1 << 32 else "<u8").tobytes() + (
        b"\0" if both.max(initial=0) < 1 << 32 else b"\1"
    )


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(packed[:-1], dtype="<u4" if packed[-1] == 0 else "<u8").astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and weights of many rows, and how many each row has."""
    found = [_unpacked(packed) for packed in column.to_pylist()]
    none = [np.empty(0, dtype=np.int64)]
    sizes = np.array([len(pairs) for pairs, _ in found], dtype=np.int64)
    return (
        np.concatenate(none + [pairs for pairs, _ in found]),
        np.concatenate(none + [weights for _, weights in found]),
        sizes,
    )


_ALIGNED = (
    "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs binary"
)


def aligned(docs: DataFrame, a: Side, b: Side, link: str = "end") -> DataFrame:
    """Every row's token, group and link counts, hash of its groups, and packed linked pairs.

    ``link`` is ``"end"`` for tokens that end at the same byte, or ``"overlap"`` for those that
    share one. A pair is ``a * (size of B) + b``.
    """
    if link not in ("end", "overlap"):
        raise ValueError("link is 'end' or 'overlap'")
    docs = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a, b, link)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, last in _runs(texts):
                found = aligner.rows(texts[first:last])
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        *[pa.array(v, k) for v, k in zip(found.values(), kinds, strict=True)],
                    ],
                    names=["doc_id", *found],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, {_ALIGNED}")


def token_groups(docs: DataFrame, a: Side, b: Side) -> DataFrame:
    """Every group of every row: doc_id, place, start and end byte, and the ids of both sides.

    Bytes are counted in the text with its leading space.
    """
    docs = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a, b, "end")
        for batch in batches:
            for row, text in enumerate(batch.column(1).to_pylist()):
                (ids_a,), (ids_b,) = aligner.tokens([text])
                ids_a, starts_a, ends_a = _spans([ids_a], aligner.sizes_a)
                ids_b, starts_b, ends_b = _spans([ids_b], aligner.sizes_b)
                groups_a, groups_b, n = coalesced(starts_a, ends_a, starts_b, ends_b)
                cut_a = np.searchsorted(groups_a, np.arange(n + 1))
                cut_b = np.searchsorted(groups_b, np.arange(n + 1))
                lists = [
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int64()))
                    for cuts, ids in ((cut_a, ids_a), (cut_b, ids_b))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(0)[row].as_py()] * n, batch.schema.field(0).type),
                        pa.array(np.arange(n)),
                        pa.array(starts_a[cut_a[:-1]]),
                        pa.array(ends_a[cut_a[1:] - 1]),
                        *lists,
                    ],
                    names=["doc_id", "place", "start", "end", "a", "b"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        run,
        f"doc_id {kind}, place bigint, start bigint, end bigint, a array<bigint>, b array<bigint>",
    )


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """``pair``, ``n`` over all ``rows``, and ``best``: whether no pair of its B id has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def combined() -> tuple[np.ndarray, np.ndarray]:
            return _summed(*map(np.concatenate, zip(*held, strict=True)))

        n = 0
        for batch in batches:
            # A few rows at a time: their pairs take more room than the rows.
            for first in range(0, batch.num_rows, 512):
                pairs, weights, _ = _flat(batch.column(0).slice(first, 512))
                held.append((pairs, weights))
                n += len(pairs)
                if n >= _HELD:
                    held = [combined()]
                    n = len(held[0][0])
                    if n >= _KEPT:
                        yield _batch(pair=held[0][0], n=held[0][1])
                        held, n = [], 0
        if held:
            pairs, weights = combined()
            yield _batch(pair=pairs, n=weights)

    partial = rows.select("pairs").mapInArrow(run, "pair bigint, n bigint")
    counts = stored(partial.groupBy("pair").agg(F.sum("n").alias("n")), "alignment-counts")
    id_b = (F.col("pair") % size_b).alias("id_b")
    # One row for each id of B.
    highest = F.broadcast(counts.groupBy(id_b).agg(F.max("n").alias("highest")))
    ranked = counts.select("pair", "n", id_b).join(highest, "id_b")
    out = stored(
        ranked.select("pair", "n", (F.col("n") == F.col("highest")).alias("best")),
        "alignment-pairs",
    )
    discard(counts)
    return out


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=[*columns])


def digest(
    docs: DataFrame, a: Side, b: Side, link: str = "end", max_pairs: int = MAX_PAIRS
) -> DataFrame:
    """Every row's counts, group hash, and what the corpus-wide counts of its links say.

    ``n_best`` counts links whose pair is the most frequent one of its B id, ties included;
    ``count_sum`` adds the counts of the pairs of all links.
    """
    rows = stored(
        aligned(docs, a, b, link).withColumn("row", F.monotonically_increasing_id()), "alignment"
    )
    counts = pair_counts(rows, len(b.pieces))
    table = frequent(counts, max_pairs).orderBy("pair").toArrow()
    # At most ``max_pairs`` rows of two numbers and a flag.
    shared = docs.sparkSession.sparkContext.broadcast(
        [table.column(i).to_numpy() for i in range(3)]
    )
    others = [name for name in rows.columns if name != "pairs"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*others).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                some = batch.slice(first, 512)
                pairs, weights, sizes = _flat(some.column("pairs"))
                row = np.repeat(np.arange(len(sizes)), sizes)
                at = np.searchsorted(known, pairs)
                at[at == len(known)] = 0
                hit = known[at] == pairs if len(known) else np.zeros(len(pairs), dtype=bool)
                at, there = at[hit], row[hit]
                # Sums of whole numbers, not of doubles.
                n_best = np.zeros(len(sizes), dtype=np.int64)
                np.add.at(n_best, there, weights[hit] * best[at])
                count_sum = np.zeros(len(sizes), dtype=np.int64)
                np.add.at(count_sum, there, weights[hit] * n[at])
                cuts = np.zeros(len(sizes) + 1, dtype=np.int32)
                np.cumsum(np.bincount(row[~hit], minlength=len(sizes)), out=cuts[1:])
                rare = pa.StructArray.from_arrays(
                    [pa.array(pairs[~hit]), pa.array(weights[~hit])], names=["pair", "times"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *[some.column(name) for name in others],
                        pa.array(n_best),
                        pa.array(count_sum),
                        pa.ListArray.from_arrays(pa.array(cuts), rare),
                    ],
                    names=[*others, "n_best", "count_sum", "rare"],
                )

    out = stored(
        rows.select(*others, "pairs").mapInArrow(
            run,
            f"{kinds}, n_best bigint, count_sum bigint, "
            "rare array<struct<pair: bigint, times: bigint>>",
        ),
        "alignment-links",
    )
    discard(rows)
    # Pairs outside the table: none of them is frequent, so none is a hot key.
    met = out.select("row", F.inline("rare")).join(counts, "pair")
    more = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    zero = F.lit(0).cast("bigint")
    return out.join(more, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", zero)).alias("count_sum"),
        "groups_sha256",
    )
