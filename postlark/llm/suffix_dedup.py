"""Removal of every byte that lies in a long string which the corpus has twice, by suffix arrays.

Texts are UTF-8 bytes. A string of ``LENGTH`` bytes that starts at two places, in one document or in
two, is repeated; every byte that a repeated string covers is removed, all occurrences included.
Strings are judged on the input.

Suffixes are dealt to shards by content, so that equal strings meet: in every string of ``LENGTH``
bytes, one place has the smallest hash of the ``GRAM`` bytes that follow it (of equal ones the last).
Neighbouring strings share that place, the anchor. A segment is the text of all strings of an
anchor; equal strings have equal anchors, so only segments with the same anchor bytes need to meet.

1. Anchor hashes are counted; only segments of anchors that occur twice or more go on.
2. Equal segments are counted and stand once, with their number.
3. Shards of about ``SHARD_BYTES`` of segments, by anchor, get a suffix array each by induced sorting,
   and the common prefixes of neighbours in it (module ``induced``). Neighbours that share ``LENGTH``
   bytes are one string; it is repeated if its occurrences, with the numbers of their segments, are
   two or more.
4. The covered stretches return to the documents of each segment and are merged.

An anchor with more than ``MAX_VARIANTS`` different segments, as many as would make a shard large, is
not sorted in one shard: its strings are dealt out one by one by a 128-bit hash and counted.

Shuffled are hashes and places of repeated segments, the bytes of different ones, and each text once
to meet its stretches. A bitmap of fixed size keeps other anchors out.

Edge cases: a null text is empty; a text shorter than ``LENGTH`` has no string. Rows that are equal
are separate documents, so all their strings are repeated. A null id is an id. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlark.llm import induced, sieve, words
from postlark.llm.rows import release, small_batches
from postlark.session import discard, stored

LENGTH = 200
GRAM = 64
SHARD_BYTES = 1 << 19
MAX_VARIANTS = 4096
# Small enough for a processor's cache.
CHUNK_BYTES = 1 << 17
# Rows that a task sends at a time, and strings that it cuts at a time.
SENT_BYTES, SENT_STRINGS = 1 << 21, 1 << 14


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours: of a block's end and of the next block's start."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def segments(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, start, size and anchor hash of each segment."""
    n = len(buf) - GRAM + 1
    width = LENGTH - GRAM + 1
    if n < width:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none.view(np.uint64)
    powers, inverse = words._power_tables(len(buf))
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(words._BYTE_VALUES[buf] * powers[: len(buf)], out=sums[1:])
    grams = (sums[GRAM:] - sums[:n]) * inverse[:n]
    place_bits = np.uint64(int(n).bit_length())
    mask = (np.uint64(1) << place_bits) - np.uint64(1)
    turned = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    # The top bits are the hash, the others make the last of equal ones the least.
    keys = (turned & ~mask) | (mask - np.arange(n, dtype=np.uint64))
    anchor = (mask - (_sliding_least(keys, width) & mask)).astype(np.int64)
    # Only strings within one text count.
    whole = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    rows = np.repeat(np.arange(len(whole)), whole)
    starts = np.arange(len(rows)) + np.repeat(offsets[:-1] - (np.cumsum(whole) - whole), whole)
    anchor = anchor[starts]
    if not len(starts):
        return rows, starts, starts, starts.view(np.uint64)
    first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (rows[1:] != rows[:-1])))
    count = np.diff(np.append(first, len(starts)))
    return rows[first], starts[first], count + LENGTH - 1, words.mix(grams[anchor[first]])


def _keys(ids: np.ndarray, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A number for each place of a text."""
    own = words.mix(hashes.view(np.uint64) ^ words.mix(ids.view(np.uint64)))
    return words.mix(own ^ words.mix(starts.astype(np.uint64))).view(np.int64)


def _sig(data: bytes) -> int:
    return int.from_bytes(hashlib.md5(data, usedforsecurity=False).digest()[:8], "little", signed=True)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("hash"), "text")


def _scan(docs: DataFrame, schema: str, make, bitmap=None, by_place: bool = False) -> DataFrame:
    """What ``make`` yields for the segments of every chunk, or for those that a bitmap lets pass.

    The bitmap is of anchors, or of places. About ``SENT_BYTES`` of rows are held at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).cast(pa.int64()).fill_null(-1).to_numpy()
            hashes = batch.column(1).to_numpy()
            made, size = [], 0
            for first, buf, offsets in words.chunks(batch.column(2), CHUNK_BYTES):
                rows, starts, sizes, anchors = segments(buf, offsets)
                at = starts - offsets[rows]
                keys = _keys(ids[first + rows], hashes[first + rows], at)
                if bitmap is not None:
                    tested = keys if by_place else anchors.view(np.int64)
                    passed = sieve.passes(tested, bitmap.value)
                    rows, starts, sizes, at = (x[passed] for x in (rows, starts, sizes, at))
                    keys, anchors = keys[passed], anchors[passed]
                found = {
                    "row": first + rows,
                    "start": starts,
                    "size": sizes,
                    "at": at,
                    "key": keys,
                    "anchor": anchors.view(np.int64),
                }
                for part in make(batch, buf, found):
                    made.append(part)
                    size += part.nbytes
                    if size >= SENT_BYTES:
                        yield from pa.Table.from_batches(made).combine_chunks().to_batches()
                        made, size = [], 0
            if made:
                yield from pa.Table.from_batches(made).combine_chunks().to_batches()
        release()

    return _texts(docs).mapInArrow(run, schema)


def _counted(batch, buf, found) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_arrays([pa.array(found["anchor"])], names=["anchor"])


def _occurrence(batch, buf, found) -> Iterator[pa.RecordBatch]:
    data = buf.tobytes()
    sigs = [
        _sig(data[a : a + n])
        for a, n in zip(found["start"].tolist(), found["size"].tolist(), strict=True)
    ]
    rows = pa.array(found["row"])
    yield pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(rows),
            batch.column(1).take(rows),
            pa.array(found["at"]),
            pa.array(found["size"].astype(np.int32)),
            pa.array(found["key"]),
            pa.array(found["anchor"]),
            pa.array(sigs, pa.int64()),
        ],
        names=["doc_id", "hash", "at", "size", "key", "anchor", "sig"],
    )


def _bytes(batch, buf, found) -> Iterator[pa.RecordBatch]:
    data = buf.tobytes()
    own = [
        data[a : a + n]
        for a, n in zip(found["start"].tolist(), found["size"].tolist(), strict=True)
    ]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(found["anchor"]),
            pa.array([_sig(d) for d in own], pa.int64()),
            pa.array(own, pa.binary()),
        ],
        names=["anchor", "sig", "data"],
    )


def _strings(batch, buf, found) -> Iterator[pa.RecordBatch]:
    """Each string of the segments by itself, a part at a time."""
    data = buf.tobytes()
    counts = found["size"] - LENGTH + 1
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    for first in range(0, total, SENT_STRINGS):
        place = np.arange(first, min(first + SENT_STRINGS, total))
        which = np.searchsorted(ends, place, side="right")
        step = place - (ends - counts)[which]
        digests = [
            hashlib.md5(data[a : a + LENGTH], usedforsecurity=False).digest()
            for a in (found["start"][which] + step).tolist()
        ]
        rows = pa.array(found["row"][which])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(rows),
                batch.column(1).take(rows),
                pa.array(found["at"][which] + step),
                pa.array(found["anchor"][which]),
                pa.array(digests, pa.binary()),
            ],
            names=["doc_id", "hash", "at", "anchor", "string"],
        )


def _id(docs: DataFrame) -> str:
    return f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, hash bigint"


def repeated_stretches(data: list[bytes], counts: list[int]) -> list[list[tuple[int, int]]]:
    """The stretches of each segment that repeated strings cover.

    ``counts`` says how often each segment occurs. Only the strings that a segment stands for count,
    not those that start in its last bytes and belong to other segments.
    """
    if not data:
        return []
    sizes = np.array([len(d) for d in data], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.frombuffer(b"\0".join(data) + b"\0", dtype=np.uint8).astype(np.int16) + 1
    text[starts[1:] - 1] = 0
    weight = np.zeros(len(text), dtype=np.int64)
    for start, size, count in zip(starts[:-1].tolist(), sizes.tolist(), counts, strict=True):
        weight[start : start + size - LENGTH + 1] = count
    array, tied = induced.suffix_array(text, LENGTH)
    shared = induced.common_prefixes(text, array, tied, 3 * LENGTH)
    run = np.cumsum(shared[array] < LENGTH)
    total = np.bincount(run, weights=weight[array])
    hits = np.sort(array[(total[run] >= 2) & (weight[array] > 0)])
    out: list[list[tuple[int, int]]] = []
    cuts = np.searchsorted(hits, starts)
    for start, a, b in zip(starts[:-1].tolist(), cuts[:-1], cuts[1:], strict=True):
        out.append(merged([(x - start, x - start + LENGTH) for x in hits[a:b].tolist()]))
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching stretches made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _sorted_shard(variants: pa.Table, data: pa.Table) -> pa.Table:
    """The stretches of the segments of one shard: ``variants`` has their numbers."""
    columns = [variants[name].to_pylist() for name in ("anchor", "sig", "n")]
    counts = {(anchor, sig): n for anchor, sig, n in zip(*columns, strict=True)}
    columns = [data[name].to_pylist() for name in ("anchor", "sig", "data")]
    own = {(a, s): d for a, s, d in zip(*columns, strict=True) if (a, s) in counts}
    keys = sorted(own)
    found = repeated_stretches([own[key] for key in keys], [counts[key] for key in keys])
    release()
    return pa.table(
        {
            "anchor": pa.array([key[0] for key in keys], pa.int64()),
            "sig": pa.array([key[1] for key in keys], pa.int64()),
            "starts": pa.array([[s for s, _ in spans] for spans in found], pa.list_(pa.int64())),
            "ends": pa.array([[e for _, e in spans] for spans in found], pa.list_(pa.int64())),
        }
    )


def covered(docs: DataFrame, max_variants: int = MAX_VARIANTS) -> DataFrame:
    """``doc_id``, ``hash`` of the text, and the lists ``at``, ``starts`` and ``ends`` of stretches."""
    with small_batches(docs.sparkSession):
        return _covered(docs, max_variants)


def _covered(docs: DataFrame, max_variants: int) -> DataFrame:
    context = docs.sparkSession.sparkContext
    anchors = _scan(docs, "anchor bigint", _counted).groupBy("anchor").count().where("count > 1")
    anchors = stored(anchors.select("anchor"), "repeated-anchors")
    bitmap = context.broadcast(sieve.sieve(anchors))
    schema = f"{_id(docs)}, at bigint, size int, key bigint, anchor bigint, sig bigint"
    found = _scan(docs, schema, _occurrence, bitmap)
    found = stored(found.join(anchors, "anchor"), "segments")
    variants = stored(
        found.groupBy("anchor", "sig").agg(
            F.count("*").alias("n"), F.min("key").alias("key"), F.max("size").alias("size")
        ),
        "variants",
    )
    hot = variants.groupBy("anchor").count().where(F.col("count") > max_variants).select("anchor")
    hot = stored(hot, "hot-anchors")
    sorted_out = _by_shards(docs, variants.join(hot, "anchor", "left_anti"))
    discard(anchors, variants)
    own = found.select("doc_id", "hash", "at", "anchor", "sig").join(sorted_out, ["anchor", "sig"])
    own = own.select("doc_id", "hash", "at", "starts", "ends")
    if not hot.isEmpty():
        own = own.unionByName(_by_strings(docs, hot))
    # Rows equal in id and text have the same stretches, and share one list of them.
    return own.groupBy("doc_id", "hash").agg(
        F.collect_set(F.struct("at", "starts", "ends")).alias("found")
    )


def _by_shards(docs: DataFrame, variants: DataFrame) -> DataFrame:
    """Stretches of each variant, by the suffix arrays of shards."""
    variants = stored(variants, "sorted-variants")
    total = variants.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shards = max(1, -(-int(total) // SHARD_BYTES))
    bitmap = docs.sparkSession.sparkContext.broadcast(sieve.sieve(variants.select("key")))
    data = _scan(docs, "anchor bigint, sig bigint, data binary", _bytes, bitmap, by_place=True)
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
    numbers = variants.select("anchor", "sig", "n", shard).groupBy("shard")
    texts = data.select("*", shard).groupBy("shard")
    out = numbers.cogroup(texts).applyInArrow(
        _sorted_shard, "anchor bigint, sig bigint, starts array<bigint>, ends array<bigint>"
    )
    out = stored(out.where(F.size("starts") > 0), "stretches")
    discard(variants)
    return out


def _by_strings(docs: DataFrame, hot: DataFrame) -> DataFrame:
    """Stretches of hot anchors, string by string."""
    bitmap = docs.sparkSession.sparkContext.broadcast(sieve.sieve(hot))
    schema = f"{_id(docs)}, at bigint, anchor bigint, string binary"
    strings = stored(_scan(docs, schema, _strings, bitmap).join(hot, "anchor"), "hot-strings")
    repeated = strings.groupBy("string").count().where("count > 1").select("string")
    return strings.join(stored(repeated, "repeated-strings"), "string").select(
        "doc_id",
        "hash",
        "at",
        F.array(F.lit(0).cast("bigint")).alias("starts"),
        F.array(F.lit(LENGTH).cast("bigint")).alias("ends"),
    )


def removals(docs: DataFrame, max_variants: int = MAX_VARIANTS) -> DataFrame:
    """Id, text and merged stretches to remove, as ``starts`` and ``ends``, for every row."""
    found = covered(docs, max_variants).withColumnsRenamed({"doc_id": "_id", "hash": "_hash"})
    texts = _texts(docs)
    same = texts["doc_id"].eqNullSafe(found["_id"]) & (texts["hash"] == found["_hash"])
    return texts.join(found, same, "left").select("doc_id", "text", "found")


def _merged_lists(found: pa.ListArray) -> Iterator[np.ndarray]:
    """For each row, its stretches in the text, merged, as an array of starts and ends."""
    items = found.flatten()
    at, starts, ends = (items.field(i) for i in range(3))
    sizes = np.diff(starts.offsets.to_numpy())
    shift = np.repeat(at.to_numpy(), sizes)
    begin, end = (x.flatten().to_numpy() + shift for x in (starts, ends))
    first = np.concatenate([[0], np.cumsum(sizes)])
    counts = pc.fill_null(pc.list_value_length(found), 0).to_numpy()
    bounds = first[np.concatenate([[0], np.cumsum(counts)])]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        order = np.argsort(begin[a:b], kind="stable")
        starts, ends = begin[a:b][order], np.maximum.accumulate(end[a:b][order])
        new = np.ones(b - a, dtype=bool)
        new[1:] = starts[1:] > ends[:-1]
        last = np.append(np.flatnonzero(new)[1:] - 1, b - a - 1) if b > a else new
        yield np.stack([starts[new], ends[last]], axis=1)


def digest(docs: DataFrame, max_variants: int = MAX_VARIANTS) -> DataFrame:
    """Id, bytes, removed bytes and runs, and a hash of the bytes that stay, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1), _merged_lists(batch.column(2)), strict=True):
                data = (text.as_py() or "").encode()
                kept, last, gone = hashlib.sha256(), 0, 0
                for start, end in spans.tolist():
                    kept.update(data[last:start])
                    last, gone = end, gone + end - start
                kept.update(data[last:])
                out.append((len(data), gone, len(spans), kept.hexdigest()))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]],
                 pa.array(columns[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    with small_batches(docs.sparkSession):
        return stored(removals(docs, max_variants).mapInArrow(run, schema), "digests")
