"""Documents linked by the Jaccard similarity of their five-word shingles, exactly.

A token-group matrix: similar documents are put in groups, and a group is known by the union of its
tokens (shingle hashes). A document that is similar to a member shares at least a known number of
tokens with the group's union, so only groups that reach this number are opened and compared member
by member.

1. Documents with equal shingle sets make one class; its smallest id stands for it.
2. Classes that agree in a pair of minimum hashes, out of eight pairs, are compared with the
   smallest class that agrees with them. The similar ones are linked: they are a family. Whether
   linked or not, classes connected by such agreement are cut into groups of about ``GROUP_TOKENS``
   tokens; a class that agrees with no other is a group of its own.
3. The matrix: by the pigeonhole principle two similar sets share a token among the first
   n - ceil(0.75 n) + 1 tokens of each, in any one order of all tokens. The order puts rare tokens
   first, by counts of all tokens in a table of fixed size. Of each group and prefix token one row
   is kept. Two groups with tokens in common are a pair, unless all their members with these tokens
   are of one family, their sizes differ too much, too few tokens follow the first one in either
   set, or too few are common: what two similar sets share beyond their prefixes is limited.
4. A pair of groups is one unit of work: all sets of both meet in one task, once. Members that do
   not share enough tokens with the union of the other group are left out, the overlaps of the rest
   come from one product of matrices over the tokens that both groups have, and as many links as
   connect the families leave the task.
5. All links together give the connected components.

Counts, bitmaps and minimum hashes only steer the search; every two documents that are similar are
connected by links, and none is taken without the exact comparison of both sets. Tokens are 64-bit
hashes of the words.

Scale: copies of one text are one family after step 2 and cause no pairs. Copies that hardly reach
each other make pairs of groups, of which there are some ten thousand times fewer than pairs of
texts of a few hundred words. What is broadcast has a fixed size: the table of token counts and the
bitmaps, of ids and of tokens, that keep texts and tokens without a partner out of the shuffles.
Python tasks take texts a few megabytes at a time.

Edge cases: a null or empty text, or one without words, has no shingles and is linked with nothing.
A text of fewer than five words has one shingle, all its words. Rows with the same id are one
document whose rows are linked. A row with a null id takes no part and has a null component. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlark.llm import sieve, words
from postlark.llm.graph import components
from postlark.llm.rows import small_batches
from postlark.session import discard, stored

SHINGLE = 5
PERCENT = 75
BANDS = 8
GROUP_TOKENS = 1 << 16
COUNT_BITS = 22
# Numbers in a matrix of a pair of groups, of which the columns are taken in parts.
MATRIX = 1 << 21

_MULTIPLIERS = words.mix(np.arange(1, 2 * BANDS + 1, dtype=np.uint64)) | np.uint64(1)


def _needed(n: int) -> int:
    """Tokens that a set of n shares with any similar set."""
    return -(-PERCENT * n // 100)


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, buf, offsets in words.chunks(texts):
        buf = words.LOWER[buf]
        rows, starts, ends = words.word_spans(buf, offsets)
        hashes = words.span_hashes(buf, starts, ends)
        at, found = words.window_hashes(hashes, rows, k)
        owners = rows[at]
        sizes = np.bincount(rows, minlength=len(offsets) - 1)
        for few in range(1, k):
            short = sizes[rows] == few
            at, whole = words.window_hashes(hashes[short], rows[short], few)
            owners = np.concatenate([owners, rows[short][at]])
            found = np.concatenate([found, words.mix(whole + np.uint64(few))])
        order = np.argsort(owners, kind="stable")
        found, owners = found[order], owners[order]
        bounds = np.searchsorted(owners, np.arange(len(offsets)))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield np.unique(found[a:b])


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (id, text) a few megabytes of text at a time."""
    for batch in batches:
        for first, _, offsets in words.chunks(batch.column(1)):
            yield batch.slice(first, len(offsets) - 1)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    shared = _shared(a, b)
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared) and shared > 0


def _shared(a: np.ndarray, b: np.ndarray, within: bool = False) -> int:
    """How many of the tokens of one sorted set are in the other; ``within``: those of ``a``."""
    if len(a) > len(b) and not within:
        a, b = b, a
    if not len(a) or not len(b):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _band_keys(tokens: np.ndarray) -> list[int]:
    """A key for each pair of minimum hashes."""
    low = np.concatenate(
        [(tokens[:, None] * _MULTIPLIERS[None, i : i + 4]).min(axis=0)
         for i in range(0, 2 * BANDS, 4)]
    )
    pairs = words.mix(low[0::2] ^ words.mix(low[1::2] + np.arange(BANDS, dtype=np.uint64)))
    return pairs.view(np.int64).tolist()


_COUNTED = "doc_id bigint, n_shingles bigint, sig binary, bands array<bigint>, seen binary"


def described(docs: DataFrame, count_bits: int = COUNT_BITS) -> DataFrame:
    """Size, signature and band keys of every set; and, from each task, token counts.

    The rows of counts have ``seen``, and nothing else. Tokens are counted in ``2 ** count_bits``
    cells by the top bits of the hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << count_bits, dtype=np.uint32)
        shift = np.uint64(64 - count_bits)
        for batch in _few(batches):
            sizes, sigs, bands, every = [], [], [], [np.empty(0, dtype=np.uint64)]
            for tokens in shingle_sets(batch.column(1)):
                sizes.append(len(tokens))
                turned = words.mix(tokens ^ _MULTIPLIERS[0])
                sigs.append(np.array([tokens.sum(), turned.sum()], dtype=np.uint64).tobytes())
                bands.append(_band_keys(tokens) if len(tokens) else [])
                every.append(tokens)
            at, times = np.unique(np.concatenate(every) >> shift, return_counts=True)
            cells[at.astype(np.int64)] += times.astype(np.uint32)
            yield _batch(batch.column(0), sizes, sigs, bands)
        yield _batch([None], [0], [None], [None], _pack(cells))

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _COUNTED)


def _batch(ids, sizes, sigs, bands, seen=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()) if isinstance(ids, list) else ids,
            pa.array(sizes, pa.int64()),
            pa.array(sigs, pa.binary()),
            pa.array(bands, pa.list_(pa.int64())),
            pa.array([seen] * len(sizes), pa.binary()),
        ],
        names=["doc_id", "n_shingles", "sig", "bands", "seen"],
    )


def _pack(cells: np.ndarray) -> bytes:
    return zstandard.compress(cells.tobytes(), 1)


def token_counts(rows: DataFrame, count_bits: int = COUNT_BITS) -> np.ndarray:
    """The sum of all tasks' token counts: a table of fixed size.

    Tables are added up on the executors first, so that at most 16 of them reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << count_bits, dtype=np.uint32)
        for batch in batches:
            for seen in batch.column(0):
                cells += np.frombuffer(zstandard.decompress(seen.as_py()), dtype=np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array([_pack(cells)])], names=["seen"])

    tables = rows.where("seen IS NOT NULL").select("seen").coalesce(16)
    out = np.zeros(1 << count_bits, dtype=np.uint32)
    for row in tables.mapInArrow(run, "seen binary").toLocalIterator():
        out += np.frombuffer(zstandard.decompress(row["seen"]), dtype=np.uint32)
    return out


def prefix(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The tokens of which similar sets share one: the rarest n - ceil(0.75 n) + 1."""
    if not len(tokens):
        return tokens
    shift = np.uint64(65 - len(counts).bit_length())
    order = np.lexsort((tokens, counts[tokens >> shift]))
    return tokens[order[: len(tokens) - _needed(len(tokens)) + 1]]


def prefix_tokens(docs: DataFrame, counts, bitmap=None) -> DataFrame:
    """``doc_id``, ``token`` and ``follow`` of every prefix, or of tokens that a bitmap lets pass.

    ``follow`` is the number of tokens of the set from this one on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, dtype=np.uint64)
        for batch in _few(batches):
            sets = list(shingle_sets(batch.column(1)))
            picked = [prefix(tokens, counts.value) for tokens in sets]
            sizes = [len(tokens) for tokens in picked]
            follow = [len(a) - np.arange(len(b)) for a, b in zip(sets, picked, strict=True)]
            follow = np.concatenate([np.empty(0, dtype=np.int64), *follow])
            tokens = np.concatenate([none, *picked]).view(np.int64)
            at = np.repeat(np.arange(len(sizes)), sizes)
            if bitmap is not None:
                passed = sieve.passes(tokens, bitmap.value)
                tokens, at, follow = tokens[passed], at[passed], follow[passed]
            ids = batch.column(0).take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(tokens), pa.array(follow)], names=["doc_id", "token", "follow"]
            )

    texts = docs.select(F.col("doc_id").cast("bigint"), "text").where("doc_id IS NOT NULL")
    return texts.mapInArrow(run, "doc_id bigint, token bigint, follow bigint")


def some_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id`` and its packed ``tokens``, for documents of a table of ids and few others.

    A bitmap of the ids keeps nearly all other texts out; a join with the ids drops the rest.
    """
    bitmap = docs.sparkSession.sparkContext.broadcast(sieve.sieve(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            passed = sieve.passes(batch.column(0).to_numpy(), bitmap.value)
            batch = batch.filter(pa.array(passed))
            packed = [tokens.tobytes() for tokens in shingle_sets(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary())], names=["doc_id", "tokens"]
            )

    texts = docs.select(F.col("doc_id").cast("bigint"), "text").where("doc_id IS NOT NULL")
    return texts.mapInArrow(run, "doc_id bigint, tokens binary").where(F.length("tokens") > 0)


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id`` and its packed ``tokens``, for the documents of a table of ids."""
    return stored(some_sets(docs, ids).join(ids.distinct(), "doc_id"), "shingle-sets")


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint64)


def _compared(
    pairs: DataFrame, sets: DataFrame, others: DataFrame, test, unpack=_unpack
) -> DataFrame:
    """The pairs ``a``-``b`` whose two packed sets pass ``test``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(i) for i in (2, 3))
            passed = [
                test(unpack(left[i].as_py()), unpack(right[i].as_py())) for i in range(len(left))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))

    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("_a")), "a")
    both = both.join(others.select(F.col("doc_id").alias("b"), F.col("tokens").alias("_b")), "b")
    return both.select("a", "b", "_a", "_b").mapInArrow(run, "a bigint, b bigint")


def _near_in_size(a: str, b: str) -> Column:
    """Whether sets of these sizes can be similar."""
    return (100 * F.col(a) >= PERCENT * F.col(b)) & (100 * F.col(b) >= PERCENT * F.col(a))


def agreeing(classes: DataFrame) -> DataFrame:
    """Pairs ``a``-``b`` of classes with the smallest class that has the same key in some band."""
    keys = classes.select(
        F.col("rep").alias("a"), "n_shingles", F.posexplode("bands").alias("band", "key")
    )
    first = F.min(F.struct(F.col("a").alias("b"), F.col("n_shingles").alias("_n")))
    leaders = stored(
        keys.groupBy("band", "key")
        .agg(first.alias("_first"), F.max("a").alias("_last"))
        .where("_first.b <> _last")
        .select("band", "key", "_first.*"),
        "band-leaders",
    )
    pairs = keys.join(leaders, ["band", "key"]).where("a <> b")
    pairs = pairs.where(_near_in_size("n_shingles", "_n")).select("a", "b").distinct()
    pairs = stored(pairs, "band-pairs")
    discard(leaders)
    return pairs


def family_links(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that are similar."""
    sets = sets_of(docs, _ids(pairs, "a", "b"))
    links = stored(_compared(pairs, sets, sets, similar), "family-links")
    discard(sets)
    return links


def _ids(df: DataFrame, *names: str) -> DataFrame:
    out = None
    for name in names:
        own = df.select(F.col(name).alias("doc_id"))
        out = own if out is None else out.unionByName(own)
    return out.distinct()


def grouped(classes: DataFrame, families: DataFrame, clusters: DataFrame) -> DataFrame:
    """``rep``, its size, its family, and its group: clusters cut to about ``GROUP_TOKENS``.

    ``compared`` tells that a cluster has two members at most, which were compared as they agree.
    """
    sized = clusters.join(
        classes.select(F.col("rep").alias("node"), "n_shingles"), "node"
    ).withColumnRenamed("component", "cluster")
    totals = sized.groupBy("cluster").agg(
        F.sum("n_shingles").alias("tokens"), (F.count("*") <= 2).alias("compared")
    )
    parts = F.ceil(F.col("tokens") / GROUP_TOKENS)
    group = F.xxhash64("cluster", F.pmod(F.xxhash64("node"), parts))
    placed = sized.join(totals, "cluster").select(
        F.col("node").alias("rep"), group.alias("grp"), "compared"
    )
    known = families.select(F.col("node").alias("rep"), F.col("component").alias("family"))
    return (
        classes.select("rep", "n_shingles")
        .join(placed, "rep", "left")
        .join(known, "rep", "left")
        .select(
            "rep",
            "n_shingles",
            F.coalesce("family", "rep").alias("family"),
            F.coalesce("grp", F.xxhash64("rep", F.lit(0))).alias("grp"),
            F.coalesce("compared", F.lit(True)).alias("compared"),
        )
    )


def token_matrix(docs: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    """One row for each group and prefix token that two families have.

    It has the least and most of the families and sizes of the members with the token, and of the
    tokens that follow it.
    """
    context = docs.sparkSession.sparkContext
    counts = context.broadcast(token_counts(rows))
    repeated = prefix_tokens(docs, counts).groupBy("token").count().where("count > 1")
    repeated = stored(repeated.select("token"), "repeated-tokens")
    bitmap = context.broadcast(sieve.sieve(repeated))
    own = prefix_tokens(docs, counts, bitmap).withColumnRenamed("doc_id", "rep")
    matrix = stored(
        own.join(groups, "rep")
        .groupBy("token", "grp")
        .agg(
            F.min("family").alias("first"),
            F.max("family").alias("last"),
            F.min("n_shingles").alias("least"),
            F.max("n_shingles").alias("most"),
            F.max("follow").alias("follow"),
            F.max("compared").alias("compared"),
        ),
        "token-groups",
    )
    between = matrix.groupBy("token").agg(F.min("first").alias("_a"), F.max("last").alias("_b"))
    between = stored(between.where("_a <> _b").select("token"), "family-tokens")
    out = stored(matrix.join(between, "token"), "token-matrix")
    discard(repeated, matrix, between)
    return out


def group_pairs(matrix: DataFrame) -> DataFrame:
    """Pairs ``a`` <= ``b`` of groups that may have similar members of two families."""
    other = matrix.select("token", *[F.col(n).alias(f"_{n}") for n in matrix.columns[1:]])
    two = (F.col("first") != F.col("last")) | (F.col("_first") != F.col("_last"))
    families = F.when(F.col("grp") == F.col("_grp"), two & ~F.col("compared")).otherwise(
        two | (F.col("first") != F.col("_first"))
    )
    sizes = (100 * F.col("most") >= PERCENT * F.col("_least")) & (
        100 * F.col("_most") >= PERCENT * F.col("least")
    )
    # Of two similar sets, so many tokens follow from the first one that they share on, itself
    # included: their overlap is p / (100 + p) of both sizes.
    overlap = F.ceil((F.col("least") + F.col("_least")) * PERCENT / (100 + PERCENT))
    found = (
        matrix.join(other, "token")
        .where((F.col("grp") <= F.col("_grp")) & families & sizes)
        .groupBy(F.col("grp").alias("a"), F.col("_grp").alias("b"))
        .agg(
            F.count("*").alias("shared"),
            F.max(F.least("follow", "_follow") >= overlap).alias("enough"),
            F.min(F.least("least", "_least")).alias("lo"),
            F.max(F.greatest("most", "_most")).alias("hi"),
        )
    )
    # What two sets share beyond their common prefix tokens is at most the rest of the one whose
    # prefix ends first, less than p / 100 of its size. The remainder is in both prefixes.
    p = PERCENT
    needed = 100 * (100 + p) * F.col("shared") >= 100 * p * F.col("lo") - p * p * F.col("hi")
    return found.where(F.col("enough") & needed).select("a", "b")


class Block:
    """The sets of a group."""

    def __init__(self, members: list[dict]):
        self.reps = np.array([m["rep"] for m in members], dtype=np.int64)
        self.families = np.array([m["family"] for m in members], dtype=np.int64)
        self.sets = [_unpack(m["tokens"]) for m in members]
        self.sizes = np.array([len(tokens) for tokens in self.sets], dtype=np.int64)

    def places(self, union: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and column of every token that is in a sorted union."""
        rows, columns = [], []
        for row, tokens in enumerate(self.sets):
            at = np.searchsorted(union, tokens)
            at[at == len(union)] = 0
            at = at[union[at] == tokens] if len(union) else at[:0]
            rows.append(np.full(len(at), row))
            columns.append(at)
        return np.concatenate(rows), np.concatenate(columns)

    def tokens(self) -> np.ndarray:
        return np.concatenate(self.sets)


def _overlaps(n: int, m: int, own, other, width: int) -> np.ndarray:
    """Shared tokens of every two sets, by products of parts of two matrices of ones."""
    out = np.zeros((n, m), dtype=np.int64)
    step = max(MATRIX // max(n, m, 1), 1)
    for first in range(0, width, step):
        parts = []
        for size, (rows, columns) in ((n, own), (m, other)):
            within = (columns >= first) & (columns < first + step)
            part = np.zeros((size, min(step, width - first)), dtype=np.float32)
            part[rows[within], columns[within] - first] = 1
            parts.append(part)
        out += (parts[0] @ parts[1].T).astype(np.int64)
    return out


def block_links(a: Block, b: Block | None) -> list[tuple[int, int]]:
    """Links that connect the families with similar members in two groups, or within one."""
    other = a if b is None else b
    if b is None:
        union, times = np.unique(a.tokens(), return_counts=True)
        union = union[times > 1]
    else:
        union = np.intersect1d(a.tokens(), b.tokens())
    own_places, other_places = a.places(union), other.places(union)
    # Members that share too little with the union of the other group are not compared.
    kept = [
        np.flatnonzero(
            100 * np.bincount(places[0], minlength=len(block.sets)) >= PERCENT * block.sizes
        )
        for block, places in ((a, own_places), (other, other_places))
    ]
    if not len(kept[0]) or not len(kept[1]):
        return []
    parts = []
    for block, places, stay in ((a, own_places, kept[0]), (other, other_places, kept[1])):
        row = np.full(len(block.sets), -1)
        row[stay] = np.arange(len(stay))
        within = row[places[0]] >= 0
        parts.append((row[places[0][within]], places[1][within]))
    shared = _overlaps(len(kept[0]), len(kept[1]), *parts, len(union))
    sizes = a.sizes[kept[0]][:, None] + other.sizes[kept[1]][None, :]
    close = (100 * shared >= PERCENT * (sizes - shared)) & (shared > 0)
    close &= a.families[kept[0]][:, None] != other.families[kept[1]][None, :]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(close)), strict=True):
        i, j = kept[0][i], kept[1][j]
        x, y = root(int(a.families[i])), root(int(other.families[j]))
        if x != y:
            parent[y] = x
            out.append((int(a.reps[i]), int(other.reps[j])))
    return out


def cross_links(docs: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Links between classes of different families."""
    matrix = token_matrix(docs, rows, groups)
    pairs = stored(group_pairs(matrix), "group-pairs")
    discard(matrix)
    asked = _ids(pairs, "a", "b").withColumnRenamed("doc_id", "grp")
    members = stored(groups.join(asked, "grp").select("grp", "rep", "family"), "group-members")
    sets = some_sets(docs, members.select(F.col("rep").alias("doc_id")))
    # About ``GROUP_TOKENS`` tokens a group.
    blocks = stored(
        members.join(sets.withColumnRenamed("doc_id", "rep"), "rep")
        .groupBy("grp")
        .agg(F.collect_list(F.struct("rep", "family", "tokens")).alias("members")),
        "blocks",
    )
    discard(members)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links: list[tuple[int, int]] = []
            for row in range(batch.num_rows):
                left, right = (batch.column(i)[row].as_py() for i in (2, 3))
                same = batch.column(0)[row].as_py() == batch.column(1)[row].as_py()
                links += block_links(Block(left), None if same else Block(right))
            yield pa.RecordBatch.from_arrays(
                [pa.array([link[i] for link in links], pa.int64()) for i in (0, 1)],
                names=["a", "b"],
            )

    both = pairs.join(blocks.select(F.col("grp").alias("a"), F.col("members").alias("_a")), "a")
    both = both.join(blocks.select(F.col("grp").alias("b"), F.col("members").alias("_b")), "b")
    with small_batches(docs.sparkSession, 64):
        links = stored(
            both.select("a", "b", "_a", "_b").mapInArrow(run, "a bigint, b bigint"), "cross-links"
        )
    discard(pairs, blocks)
    return links


def linked(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row."""
    rows = stored(described(docs), "shingle-rows")
    own = rows.where("seen IS NULL")
    sets = own.where("doc_id IS NOT NULL AND n_shingles > 0")
    firsts = stored(sets.groupBy("sig").agg(F.min("doc_id").alias("rep")), "classes")
    members = stored(
        sets.select("doc_id", "sig").join(firsts, "sig").select("doc_id", "rep"), "class-members"
    )
    classes = stored(
        sets.join(firsts, "sig")
        .where("doc_id = rep")
        .groupBy("rep")
        .agg(F.max_by("bands", "n_shingles").alias("bands"), F.max("n_shingles").alias("n_shingles")),
        "class-rows",
    )
    pairs = agreeing(classes)
    family = family_links(docs, pairs)
    families, clusters = components(family), components(pairs)
    groups = stored(grouped(classes, families, clusters), "groups")
    across = cross_links(docs, rows, groups)
    same_id = members.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = components(family.unionByName(across).unionByName(same_id))
    labelled = own.select("doc_id", "n_shingles").join(
        found.withColumnRenamed("node", "doc_id"), "doc_id", "left"
    )
    out = stored(
        labelled.select(
            "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
        ),
        "linked",
    )
    discard(rows, firsts, members, classes, pairs, family, groups, across)
    return out


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without those linked, directly or not, to one with a smaller id."""
    gone = linked(docs).where("component_id < doc_id").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone.distinct(), docs["doc_id"] == F.col("_gone"), "left_anti")
