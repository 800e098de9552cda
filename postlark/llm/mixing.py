"""Mixing sources to target weights, in blocks of words.

The documents of a source are laid end to end, in an order made from hashes, and cut into blocks
of a fixed number of words. Output shards have a fixed number of slots. For each shard, a
multinomial draw says how many slots each source gets. The slots of a source, numbered over all
shards, are mapped to its blocks by pseudorandom permutations of the block indexes, a new one for
each pass over the source, and slots and blocks are joined by index.

Draws of different shards add up to a source's target only nearly, and could take a block once
more than allowed. So a source that was drawn above its target hands the slots of its last shards
to sources that were drawn below theirs. Each source then gets its target to within half a block,
and no block is taken more often than the largest repeat allows.

Weights: sources in code point order, null last, weigh 5, 2, 1, repeating. A target stops at three
times the source's size, and the excess goes to the others by weight until none is above.

Everything works on a stored table of sizes; texts take part only where output texts are asked
for. Offsets are sums in two steps, within hash chunks and then over chunks, so that a source with
a third of all rows is spread over tasks. Reruns agree, as all draws are hashes.

Edge cases: a null text has size 0, and what has size 0 is never taken. Equal rows are separate
documents. A null source is a source. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlark.llm.rows import whole_row, with_text
from postlark.session import discard, stored

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 128
SHARD_SLOTS = 4096
ROWS_PER_CHUNK = 8192
SHARDS_PER_SPAN = 1024
SLOTS_PER_TASK = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"
SEED = 20_240_601


def sizes(docs: DataFrame) -> DataFrame:
    """Id, source, text hash, a number among equal rows, and the size in words."""
    keyed = docs.select(
        "doc_id",
        "source",
        F.xxhash64("text").alias("_text"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    )
    equal = Window.partitionBy("doc_id", "_text", "source").orderBy("size")
    return keyed.withColumn("_copy", F.row_number().over(equal))


def targets(sized: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row of each source: number, size, target, blocks and slots to fill.

    The share of a source that is not at its limit is its weight times one level. Sources are
    taken in the order in which a rising level reaches their limit; the first that is not reached
    gives the level. One row of each source meets in one task here, and no others.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").isNull(), "source")
    number = F.row_number().over(in_order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), number % len(WEIGHTS) + 1)
    rows = totals.select("source", "source_size", number.alias("sid"), weight.alias("_weight"))
    limit = (MOST_REPEATS * F.col("source_size")).cast("double")
    by_reach = Window.orderBy("_reach", "sid")
    everything = Window.partitionBy()
    later = by_reach.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    earlier = by_reach.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum("_limit").over(earlier), F.lit(0.0))
    rows = (
        rows.withColumn("_limit", limit)
        .withColumn("_reach", F.col("_limit") / F.col("_weight"))
        .withColumn("_level", left / F.sum("_weight").over(later))
        .withColumn("_open", F.col("_reach") > F.col("_level"))
    )
    level = F.min(F.when(F.col("_open"), F.struct("_reach", "sid", "_level"))).over(everything)
    rows = rows.withColumn("_level", level["_level"])
    share = F.col("_weight") * F.col("_level")
    target = F.coalesce(F.least(F.col("_limit"), share), F.col("_limit"))
    blocks = F.ceil(F.col("source_size") / block_words).cast("bigint")
    per_word = F.try_divide(F.col("blocks"), F.col("source_size"))
    slots = F.round(F.col("target") * per_word).cast("bigint")
    filled = (
        rows.withColumn("target", target)
        .withColumn("blocks", blocks)
        .withColumn("slots", F.coalesce(slots, F.lit(0).cast("bigint")))
    )
    start = F.sum("slots").over(Window.orderBy("sid")) - F.col("slots")
    return filled.select(
        "source", "sid", "source_size", "target", "blocks", "slots", start.alias("slot_start")
    )


def laid_out(sized: DataFrame, sources: DataFrame, rows_per_chunk: int) -> DataFrame:
    """Every sized row with its source's columns and its word offset in the source."""
    chunks = max(1, -(-sized.count() // rows_per_chunk))
    keyed = (
        sized.withColumnRenamed("source", "_source")
        .join(sources, F.col("_source").eqNullSafe(F.col("source")))
        .drop("_source")
        .withColumn("_order", F.xxhash64(F.lit(SEED), "doc_id", "_text", "_copy"))
        .withColumn("_chunk", F.pmod(F.xxhash64("_order"), F.lit(chunks)))
    )
    chunk_sizes = keyed.groupBy("sid", "_chunk").agg(F.sum("size").alias("_chunk_size"))
    over_chunks = Window.partitionBy("sid").orderBy("_chunk")
    chunk_starts = chunk_sizes.select(
        "sid", "_chunk", (F.sum("_chunk_size").over(over_chunks) - F.col("_chunk_size")).alias("_s")
    )
    in_chunk = Window.partitionBy("sid", "_chunk").orderBy("_order", "doc_id", "_text", "_copy")
    within = keyed.withColumn(
        "_within",
        F.sum("size").over(in_chunk.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"),
    )
    return (
        within.join(chunk_starts, ["sid", "_chunk"])
        .withColumn("offset", F.col("_s") + F.col("_within"))
        .drop("_chunk", "_order", "_within", "_s")
    )


def _located(points: DataFrame, at: str, ranges: DataFrame, start: str, length: str, total: int):
    """Each point with the range that holds it: a join on cells of a grid, then a check.

    ``points`` spread evenly over the grid, and each range is repeated for the cells it touches.
    """
    cell = max(1, total // 4096)
    first, last = F.col(start), F.col(start) + F.col(length) - 1
    cells = F.sequence(F.floor(first / cell), F.floor(last / cell))
    placed = ranges.where(F.col(length) > 0).withColumn("_cell", F.explode(cells))
    points = points.withColumn("_cell", F.floor(F.col(at) / cell))
    return points.join(placed, "_cell").where(F.col(at).between(first, last)).drop("_cell")


def slots(spark, sources: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """Every output slot: ``shard``, ``sid`` and ``ordinal``, its number within the source."""
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    drawn = _located(
        spark.range(total).select(
            F.floor(F.col("id") / shard_slots).alias("shard"),
            F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(max(total, 1))).alias("_x"),
        ),
        "_x",
        sources.select("sid", "slot_start", "slots"),
        "slot_start",
        "slots",
        total,
    )
    draws = stored(drawn.groupBy("shard", "sid").agg(F.count("*").alias("_n")), "mixing-draws")
    # The draws of a source in shard order; what goes beyond its target is handed over. Slots are
    # made of the draws after these have been dealt out again, as one task may hold a whole source's.
    numbered = numbered_draws(draws).repartition(-(-total // SLOTS_PER_TASK) or 1, "shard", "sid")
    numbered = numbered.withColumn(
        "_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1))
    )
    numbered = numbered.select("shard", "sid", (F.col("_before") + F.col("_i")).alias("ordinal"))
    numbered = numbered.join(sources.select("sid", "slots"), "sid")
    regular = numbered.where(F.col("ordinal") < F.col("slots")).select("shard", "sid", "ordinal")
    balance = sources.select("sid", "slots").join(
        draws.groupBy("sid").agg(F.sum("_n").alias("_drawn")), "sid", "left"
    )
    balance = balance.withColumn("_drawn", F.coalesce("_drawn", F.lit(0).cast("bigint")))
    over = F.greatest(F.col("_drawn") - F.col("slots"), F.lit(0))
    under = F.greatest(F.col("slots") - F.col("_drawn"), F.lit(0))
    running = Window.orderBy("sid")
    balance = balance.select(
        "sid",
        "_drawn",
        under.alias("_under"),
        (F.sum(over).over(running) - over).alias("_over_start"),
        (F.sum(under).over(running) - under).alias("_under_start"),
    )
    handed = (
        numbered.where(F.col("ordinal") >= F.col("slots"))
        .join(balance.select("sid", "_over_start"), "sid")
        .select("shard", (F.col("_over_start") + F.col("ordinal") - F.col("slots")).alias("_x"))
    )
    given = balance.select("sid", "_drawn", "_under", "_under_start")
    taken = _located(handed, "_x", given, "_under_start", "_under", total).select(
        "shard", "sid", (F.col("_drawn") + F.col("_x") - F.col("_under_start")).alias("ordinal")
    )
    return regular.unionByName(taken)


def numbered_draws(draws: DataFrame) -> DataFrame:
    """Each draw with ``_before``, what its source is drawn in earlier shards.

    Sums in two steps, within spans of shards and then over spans, keep a source out of one task.
    """
    span = F.floor(F.col("shard") / SHARDS_PER_SPAN).alias("_span")
    spanned = draws.select("shard", "sid", "_n", span)
    spans = spanned.groupBy("sid", "_span").agg(F.sum("_n").alias("_of_span"))
    over_spans = Window.partitionBy("sid").orderBy("_span")
    starts = (F.sum("_of_span").over(over_spans) - F.col("_of_span")).alias("_start")
    in_span = Window.partitionBy("sid", "_span").orderBy("shard")
    within = spanned.withColumn("_within", F.sum("_n").over(in_span) - F.col("_n"))
    joined = within.join(spans.select("sid", "_span", starts), ["sid", "_span"])
    return joined.select("shard", "sid", "_n", (F.col("_start") + F.col("_within")).alias("_before"))


def permuted(index: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0 … n-1, chosen by ``key``.

    The index is a pair of digits in a table of at least n places. Rounds in which each digit is
    moved by a hash of the other permute the table, and an index that lands beyond n-1 goes on
    until it is inside. At most ``sqrt(n)`` places are beyond, so 32 goes always do up to n = 1000
    and fail with a chance below 10 to the power of -48 above; that would raise an error.
    """
    width = F.ceil(F.sqrt(n.cast("double"))).cast("bigint")
    height = F.ceil(n / width).cast("bigint")

    def turned(x: Column) -> Column:
        pair = F.struct(F.floor(x / height).alias("a"), F.pmod(x, height).alias("b"))

        def turn(p: Column, i: Column) -> Column:
            a = F.pmod(p["a"] + F.pmod(F.xxhash64(*key, i, p["b"]), width), width)
            b = F.pmod(p["b"] + F.pmod(F.xxhash64(*key, -i, a), height), height)
            return F.struct(a.alias("a"), b.alias("b"))

        rounds = F.array(*[F.lit(i) for i in (1, 2, 3)])
        return F.aggregate(rounds, pair, turn, lambda p: p["a"] * height + p["b"])

    start = F.struct(index.cast("bigint").alias("x"), F.lit(False).alias("done"))

    def step(s: Column, _: Column) -> Column:
        x = F.when(s["done"], s["x"]).otherwise(turned(s["x"]))
        return F.struct(x.alias("x"), (x < n).alias("done"))

    end = F.aggregate(F.sequence(F.lit(1), F.lit(32)), start, step)
    return F.when(end["done"], end["x"]).otherwise(
        F.raise_error(F.lit("an index left its permutation")).cast("bigint")
    )


def drawn_blocks(sources: DataFrame, filled: DataFrame) -> DataFrame:
    """Every slot with the block it takes: ``shard``, ``sid``, ``block``."""
    placed = filled.join(sources.select("sid", "blocks"), "sid")
    turn = F.floor(F.col("ordinal") / F.col("blocks"))
    index = F.pmod(F.col("ordinal"), F.col("blocks"))
    block = permuted(index, F.col("blocks"), F.lit(SEED), F.col("sid"), turn)
    return placed.select("shard", "sid", block.alias("block"))


def mix(
    docs: DataFrame,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """The documents with offsets and source columns; and the slots with their blocks."""
    spark = docs.sparkSession
    sized = stored(sizes(docs), "mixing-sizes")
    sources = stored(targets(sized, block_words), "mixing-sources")
    laid = stored(laid_out(sized, sources, rows_per_chunk), "mixing-offsets")
    blocks = stored(drawn_blocks(sources, slots(spark, sources, shard_slots)), "mixing-slots")
    discard(sized, sources)
    return laid, blocks


def pieces(laid: DataFrame, blocks: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """What each document has in each block, with the number of times the block is taken.

    A document without words has one row with 0 words.
    """
    first = F.floor(F.col("offset") / block_words)
    last = F.floor((F.col("offset") + F.greatest(F.col("size"), F.lit(1)) - 1) / block_words)
    cut = laid.withColumn("block", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("offset"), F.col("block") * block_words)
    end = F.least(F.col("offset") + F.col("size"), (F.col("block") + 1) * block_words)
    cut = cut.withColumns({"_from": start - F.col("offset"), "_words": end - start})
    times = blocks.groupBy("sid", "block").agg(F.count("*").alias("times"))
    joined = cut.join(times, ["sid", "block"], "left")
    return joined.withColumn("times", F.coalesce("times", F.lit(0).cast("bigint")))


_ROW = ["doc_id", "_text", "source", "_copy"]


def taken_words(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Id, size, source size, target and the words that the mix takes of each document."""
    laid, blocks = mix(docs, block_words)
    per_row = pieces(laid, blocks, block_words).groupBy(*_ROW, "size", "source_size", "target")
    return per_row.agg(F.sum(F.col("times") * F.col("_words")).alias("taken")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents: a row for each time that a document is taken, with the words taken.

    The first row of a document has the words of all blocks that are taken at least once, the
    second those of blocks taken twice or more, and so on. White space after a word stays. All
    columns of ``docs`` are kept; ``n_chars`` is counted anew where the text changed.
    """
    laid, blocks = mix(docs, block_words)
    turns = pieces(laid, blocks, block_words).where("times > 0 AND _words > 0")
    turns = turns.withColumn("_turn", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")))
    lists = turns.groupBy(*_ROW, "_turn").agg(
        F.array_sort(F.collect_list(F.struct("_from", "_words"))).alias("_pieces")
    )
    # Documents and lists meet by a key of two hashes, so that texts move once. The lists of equal
    # rows come together; each row takes those of its own number.
    keys = ["_k1", "_k2"]
    row = [F.col(name) for name in ("doc_id", "_text", "source")]
    lists = lists.select(*_row_keys(*row), "_copy", "_pieces").groupBy(*keys).agg(
        F.collect_list(F.struct("_copy", "_pieces")).alias("_lists")
    )
    # The row is kept as one value, whatever its columns are called.
    keyed = docs.select(
        whole_row(docs).alias("_row"),
        *_row_keys(F.col("doc_id"), F.xxhash64("text"), F.col("source")),
    )
    equal = Window.partitionBy(*keys).orderBy(F.lit(1))
    keyed = keyed.withColumn("_copy", F.row_number().over(equal))
    own = F.filter("_lists", lambda item: item["_copy"] == F.col("_copy"))
    spaced = F.regexp_extract_all(
        F.col("_row.text"), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0)
    )
    words = F.flatten(
        F.transform("_list._pieces", lambda p: F.slice("_spaced", p["_from"] + 1, p["_words"]))
    )
    joined = keyed.join(lists, keys).withColumn("_spaced", spaced)
    joined = joined.withColumn("_list", F.explode(own))
    return with_text(joined.select("_row", F.array_join(words, "").alias("_new")), docs)


def _row_keys(doc_id: Column, text_hash: Column, source: Column) -> list[Column]:
    """Two hashes that tell rows apart, null or not."""
    parts = [doc_id, text_hash, source, doc_id.isNull(), source.isNull()]
    return [F.xxhash64(*parts).alias("_k1"), F.xxhash64(F.lit(SEED), *parts).alias("_k2")]
