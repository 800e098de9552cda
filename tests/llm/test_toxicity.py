import random
import zlib

import numpy as np
import pyarrow as pa
from corpus import collected, documents, empty, labels, odd_documents, prose, with_clashes

from pyspark.sql import functions as F

from postlark.llm import compression_classifier as classifier
from postlark.llm import toxicity


def held(number):
    return zlib.crc32(str(number).encode()) % 5 == 0


def corpus(spark, n=500):
    rng = random.Random(8)
    rows, known = [], []
    bad = ["vileword", "foulterm", "rudething"]
    for number in range(n):
        own = prose(rng, rng.randint(20, 80)).split()
        toxic = number % 3 == 0
        if toxic:
            for _ in range(2):
                own.insert(rng.randrange(len(own)), rng.choice(bad) + rng.choice(["", "er", "ing"]))
        rows.append((number, " ".join(own)))
        known.append((number, 1, int(toxic)))
    return documents(spark, rows), labels(spark, known)


def test_held_out_rows_are_told_apart(spark):
    docs, known = corpus(spark)
    found = toxicity.verdicts(docs, known).collect()
    toxic = {row.doc_id: row.toxic for row in known.collect()}
    assert [row.held_out for row in found] == [held(row.doc_id) for row in found]
    unseen = [row for row in found if row.held_out]
    right = sum(row.predicted == toxic[row.doc_id] for row in unseen)
    assert right / len(unseen) > 0.9
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.5) for row in found)


def test_held_out_labels_are_not_learnt_from(spark):
    docs, known = corpus(spark, 120)
    rows = [(r.doc_id, 1, 1 - r.toxic if held(r.doc_id) else r.toxic) for r in known.collect()]
    same = collected(toxicity.verdicts(docs, known))
    assert same == collected(toxicity.verdicts(docs, labels(spark, rows)))


def test_responses_do_not_cross_texts():
    network = toxicity.Network.fresh(np.zeros(toxicity.BUCKETS, dtype=np.float32))
    network.weights[:] = np.linspace(-1, 1, len(network.weights))
    texts = ["a b c", "", "d", None, "e f a b c"]
    together = network.scores(pa.array(texts))
    alone = [network.scores(pa.array([text], pa.string()))[0] for text in texts]
    assert np.allclose(together, alone)


def test_gradient_steps_lower_the_loss():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 50, (12, 1 + len(toxicity.BEGINNINGS))).astype(np.int32) for _ in range(64)]
    y = np.array([float((d[:, 0] == 7).any()) for d in docs], dtype=np.float32)
    network = toxicity.Network.fresh(np.zeros(toxicity.BUCKETS, dtype=np.float32))

    def loss():
        z = np.array([network.logits(d, np.array([0, len(d)]))[0] for d in docs])
        return float(np.log1p(np.exp(-np.where(y == 1, z, -z))).mean())

    before = loss()
    network.train(docs, y, epochs=20)
    assert loss() < before / 2


def test_languages_are_guessed_from_the_text():
    texts = pa.array(["the cat of and to", "le chat et les un", "el gato y los de la", "der und die das"])
    ((_, hashes, _, bounds),) = list(toxicity.word_ids(texts))
    assert toxicity.languages(hashes, bounds).tolist() == [0, 1, 2, 3]


def test_odd_input(spark):
    docs, known = corpus(spark, 60)
    odd = odd_documents(spark)
    both = docs.unionByName(odd.withColumn("doc_id", odd.doc_id + 1000))
    found = collected(toxicity.verdicts(both, known))
    assert len(found) == both.count() and all(0 <= row[2] <= 1 for row in found)
    assert found == collected(toxicity.verdicts(with_clashes(both), known))
    assert toxicity.verdicts(empty(spark), known).collect() == []
    assert {row.score for row in toxicity.verdicts(odd, labels(spark, [])).collect()} == {0.5}


def test_all_labelled_rows_are_learnt_from(spark):
    """A word that is toxic in one shard only, behind the beginning of a long text, is known."""
    docs, known = corpus(spark, 600)
    end = docs.where("doc_id >= 300").withColumn(
        "text", F.concat(F.repeat(F.lit("plain filling text "), 800), "text")
    )
    docs = docs.where("doc_id < 300").unionByName(end)
    rows, shards = classifier.labelled(docs, known, "toxic", "doc_id", 300_000)
    assert shards > 5 and rows.count() == sum(not held(n) for n in range(600))
    assert rows.select("shard", "label", "turn").distinct().count() == rows.count()
    seen = toxicity._word_texts(rows)
    assert seen[:, toxicity._hash("filling") % toxicity.BUCKETS].sum() == sum(
        not held(n) for n in range(300, 600)
    )
    network = toxicity.fit(docs, known, shard_bytes=300_000)
    toxic = {row.doc_id: row.toxic for row in known.collect()}
    unseen = [row for row in docs.collect() if held(row.doc_id)]
    scores = network.scores(pa.array([row.text for row in unseen]))
    right = sum((z >= 0.5) == toxic[row.doc_id] for z, row in zip(scores, unseen, strict=True))
    assert right / len(unseen) > 0.9
    again = toxicity.fit(docs.repartition(5), known.repartition(2), shard_bytes=300_000)
    assert np.array_equal(network.parameters(), again.parameters())
