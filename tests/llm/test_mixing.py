import random
from collections import Counter

from corpus import collected, documents, empty, odd_documents, prose, with_clashes, words
from pyspark.sql import functions as F

from postlark.llm import mixing


def corpus(spark, sizes, seed=1):
    """Documents of several sources; ``sizes``: documents of each."""
    rng = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((len(rows), prose(rng, rng.randint(1, 300)), source))
    return documents(spark, rows)


def filled(sizes):
    """Targets by resharing until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {name: (5, 2, 1)[i % 3] for i, name in enumerate(names)}
    target, left, free = {}, float(sum(sizes.values())), set(names)
    while free:
        share = {name: left * weight[name] / sum(weight[n] for n in free) for name in free}
        over = {name for name in free if share[name] > 3 * sizes[name]}
        if not over:
            return target | share
        for name in over:
            target[name] = 3.0 * sizes[name]
            left -= target[name]
        free -= over
    return target


def test_targets_are_reshared_up_to_the_limit(spark):
    for sizes in (
        {"a": 10, "b": 10, "c": 10},
        {"a": 1, "b": 100, "c": 900, "d": 5, None: 20, "é": 3},
        {"a": 5, "b": 0},
        {"only": 7},
    ):
        rows = [(n, size) for n, size in sizes.items()]
        found = mixing.targets(spark.createDataFrame(rows, "source STRING, size BIGINT"))
        expected = filled(sizes)
        for row in found.collect():
            assert abs(row.target - expected[row.source]) < 1e-6 * max(1, expected[row.source])
            assert row.slots <= 3 * row.blocks


def test_sources_come_near_their_targets(spark):
    docs = corpus(spark, {"a": 20, "b": 300, "c": 60, "d": 3, None: 30})
    found = mixing.taken_words(docs).collect()
    assert len(found) == docs.count()
    source = {row.doc_id: row.source for row in docs.collect()}
    taken, target = Counter(), {}
    for row in found:
        assert row.size == len(words(docs_text(docs)[row.doc_id]))
        assert 0 <= row.taken <= 3 * row["size"]
        taken[source[row.doc_id]] += row.taken
        target[source[row.doc_id]] = row.target
    for name, goal in target.items():
        assert abs(taken[name] - goal) <= max(mixing.BLOCK_WORDS, 0.02 * goal), (name, goal)
    assert collected(mixing.taken_words(docs.repartition(5))) == sorted(map(tuple, found), key=repr)


_texts = {}


def docs_text(docs):
    if id(docs) not in _texts:
        _texts[id(docs)] = {row.doc_id: row.text for row in docs.collect()}
    return _texts[id(docs)]


def test_every_shard_draws_by_weight(spark):
    docs = corpus(spark, {"a": 100, "b": 100, "c": 100})
    sized = mixing.sizes(docs)
    sources = mixing.targets(sized, 16)
    slots = mixing.slots(spark, sources, 200).groupBy("shard", "sid").count().collect()
    per_shard = Counter()
    for row in slots:
        per_shard[row.shard] += row["count"]
    total = sources.agg(F.sum("slots")).first()[0]
    assert sum(per_shard.values()) == total
    assert set(list(per_shard.values())[:-1]) <= {200, total % 200}
    full = [row["count"] for row in slots if row.sid == 0 and per_shard[row.shard] == 200]
    assert 0.4 < sum(full) / len(full) / 200 < 0.8 and len(set(full)) > 1


def test_slots_of_a_source_take_each_block_in_turn(spark):
    docs = corpus(spark, {"a": 40, "b": 200, "c": 10})
    sources = mixing.targets(mixing.sizes(docs), 32)
    drawn = mixing.drawn_blocks(sources, mixing.slots(spark, sources, 100))
    blocks = {row.sid: row.blocks for row in sources.collect()}
    for sid, n in blocks.items():
        times = Counter(row.block for row in drawn.where(F.col("sid") == sid).collect())
        assert set(times) <= set(range(n))
        assert not times or max(times.values()) - min(times.get(b, 0) for b in range(n)) <= 1


def test_permutations_are_whole(spark):
    for n in (1, 2, 3, 7, 100, 1000):
        mapped = spark.range(n).select(
            mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(5), F.lit(2)).alias("p")
        )
        own = [row.p for row in mapped.collect()]
        assert sorted(own) == list(range(n))
        assert n < 100 or own != list(range(n))


def test_mixed_documents_hold_the_words_taken(spark):
    docs = corpus(spark, {"a": 20, "b": 60})
    docs = docs.unionByName(docs.limit(3))
    taken = Counter()
    for row in mixing.taken_words(docs).collect():
        taken[row.doc_id] += row.taken
    out = Counter()
    texts = docs_text(docs)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    for row in mixed.collect():
        own = words(row.text)
        out[row.doc_id] += len(own)
        assert row.n_chars == len(row.text) and set(own) <= set(words(texts[row.doc_id]))
    assert out == Counter({k: v for k, v in taken.items() if v})


def test_odd_input(spark):
    docs = odd_documents(spark).withColumn("source", F.when(F.col("doc_id") > 4, F.col("source")))
    found = mixing.taken_words(docs)
    assert found.count() == docs.count()
    assert {row.taken for row in found.where("doc_id < 4").collect()} == {0}
    wide = with_clashes(docs)
    assert collected(found) == collected(mixing.taken_words(wide))
    assert mixing.mixed_documents(wide).columns == wide.columns
    assert collected(mixing.mixed_documents(wide).select(docs.columns)) == collected(
        mixing.mixed_documents(docs)
    )
    assert mixing.taken_words(empty(spark)).collect() == []
    assert mixing.mixed_documents(empty(spark)).collect() == []


def test_draws_are_numbered_over_spans_of_shards(spark):
    rng = random.Random(8)
    rows = [(i, sid, rng.randint(1, 9)) for i in range(2500) for sid in (0, 1) if rng.random() < 0.7]
    found = mixing.numbered_draws(spark.createDataFrame(rows, "shard BIGINT, sid INT, _n BIGINT"))
    before, expected = Counter(), set()
    for shard, sid, n in rows:
        expected.add((shard, sid, n, before[sid]))
        before[sid] += n
    assert {tuple(row) for row in found.collect()} == expected


def test_taken_words_follow_from_the_blocks_drawn(spark):
    docs = corpus(spark, {"a": 20, "b": 80, "c": 7})
    laid, blocks = mixing.mix(docs, 16, 100)
    times = Counter((row.sid, row.block) for row in blocks.collect())
    expected = sorted(
        (row.doc_id, sum(times[row.sid, at // 16] for at in range(row.offset, row.offset + row["size"])))
        for row in laid.collect()
    )
    taken = mixing.pieces(laid, blocks, 16).groupBy("doc_id")
    taken = taken.agg(F.sum(F.col("times") * F.col("_words")).alias("taken")).collect()
    assert sorted(map(tuple, taken)) == expected
