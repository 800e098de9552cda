import random
import zlib

from corpus import collected, documents, empty, labels, odd_documents, prose, with_clashes

from postlark.llm import compression_classifier as classifier


def held(number):
    return zlib.crc32(str(number).encode()) % 5 == 0


def corpus(spark, n=300):
    rng = random.Random(3)
    rows, known = [], []
    for number in range(n):
        good = number % 4 > 0
        text = prose(rng, 80)
        rows.append((number, text if good else "".join(f"{w}$$$ " for w in text.split())))
        known.append((number, int(good), 0))
    return documents(spark, rows), labels(spark, known)


def test_held_out_rows_are_told_apart(spark):
    docs, known = corpus(spark)
    found = classifier.verdicts(docs, known).collect()
    quality = {row.doc_id: row.quality for row in known.collect()}
    assert len(found) == 300
    assert [row.held_out for row in found] == [held(row.doc_id) for row in found]
    unseen = [row for row in found if row.held_out]
    right = sum(row.predicted == quality[row.doc_id] for row in unseen)
    assert right / len(unseen) > 0.95
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.3) for row in found)


def test_held_out_labels_are_not_learnt_from(spark):
    docs, known = corpus(spark)
    rows = [(r.doc_id, 1 - r.quality if held(r.doc_id) else r.quality, 0) for r in known.collect()]
    turned = labels(spark, rows)
    same = collected(classifier.verdicts(docs, known))
    assert same == collected(classifier.verdicts(docs, turned))


def test_one_class_gives_its_share(spark):
    docs, _ = corpus(spark, 20)
    only = labels(spark, [(n, 1, 0) for n in range(20)])
    scores = {row.score for row in classifier.verdicts(docs, only).collect()}
    assert len(scores) == 1 and scores.pop() > 0.8
    nothing = classifier.verdicts(docs, labels(spark, [])).collect()
    assert {row.score for row in nothing} == {0.5}


def test_odd_input(spark):
    docs, known = corpus(spark)
    odd = odd_documents(spark)
    model = classifier.fit(docs, known)
    found = collected(classifier.score(odd, model).select("doc_id", "text", "score"))
    assert len(found) == odd.count()
    clashing = classifier.score(with_clashes(odd), model)
    assert found == collected(clashing.select("doc_id", "text", "score"))
    assert classifier.score(empty(spark), model).collect() == []
    repeated = labels(spark, [(n % 5, n % 2, None) for n in range(50)] + [(None, 1, 1)])
    assert classifier.verdicts(odd, repeated).count() == odd.count()
    assert classifier.verdicts(empty(spark), known).collect() == []


def test_dictionaries_are_trained_on_all_shards(spark):
    docs, known = corpus(spark, 600)
    rows, shards = classifier.labelled(docs, known, "quality", "doc_id", 8_000)
    assert shards > classifier.MERGED
    assert rows.count() == sum(not held(n) for n in range(600))
    sizes, kept = classifier.class_sizes(rows)
    assert sizes.sum() == rows.count() and (kept * classifier.TURNS >= sizes).all()
    model = classifier.fit(docs, known, shard_bytes=8_000)
    quality = {row.doc_id: row.quality for row in known.collect()}
    unseen = [row for row in docs.collect() if held(row.doc_id)]
    scores = model.scores([row.text.encode() for row in unseen])
    right = sum((z >= 0.3) == quality[row.doc_id] for z, row in zip(scores, unseen, strict=True))
    assert right / len(unseen) > 0.95
    assert model == classifier.fit(docs.repartition(5), known, shard_bytes=8_000)
