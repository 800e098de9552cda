import random

import numpy as np
from corpus import collected, documents, empty, odd_documents, odd_rows, prose, with_clashes, words

from postlark.llm import quality_rules


def brute(text):
    own = words(text)
    windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    covered = set()
    for i, window in enumerate(windows):
        if windows.count(window) > 1:
            covered |= {i, i + 1, i + 2}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in lines
            lines.add(line)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(own), sum(map(len, own)), symbols, dup, len(covered)


def test_counts(spark):
    rng = random.Random(2)
    texts = ["a b c a b c", "a a a a", "l 1\nl 1\n\n\nl 1 \nl 1", "#x $ |||", "é é\r\né é\n中 é é"]
    texts += ["".join(rng.choice("ab \n#") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    rows = [*enumerate(texts), *[(1000 + i, t) for i, (_, t) in enumerate(odd_rows()[:6])]]
    found = quality_rules.verdicts(documents(spark, rows))
    texts = dict(rows)
    for row in found.collect():
        expected = brute(texts[row.doc_id])
        assert tuple(row)[1:6] == expected, texts[row.doc_id]
        assert row.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (row.base_failed and row.kept)


def test_em_finds_which_rules_to_trust():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.85
    # Two rules see half of the bad texts, one sees noise, and one likes good texts.
    votes = np.zeros((4000, 4), dtype=int)
    votes[~truth, 0] = -1 * (rng.random((~truth).sum()) < 0.6)
    votes[~truth, 1] = -1 * (rng.random((~truth).sum()) < 0.6)
    votes[:, 2] = -1 * (rng.random(4000) < 0.2)
    votes[truth, 3] = rng.random(truth.sum()) < 0.8
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_rules.LabelModel.fit(patterns, counts.astype(float))
    assert abs(model.prior - 0.85) < 0.1
    _, adds, _ = model.log_odds()
    assert adds[0] < -2 and adds[1] < -2 and adds[3] > 2
    assert abs(adds[2]) < min(-adds[0], -adds[1]) / 2
    right = (model.posterior(votes) >= 0.5) == truth
    assert right.mean() > 0.9


def test_junk_goes_and_prose_stays(spark):
    rng = random.Random(4)
    clean = [(n, prose(rng, 120) + ".") for n in range(60)]
    junk = [(100 + n, "".join(f"{w}$$$ %%% " for w in prose(rng, 60).split())) for n in range(8)]
    junk += [(200 + n, " ".join(w.upper() + "!!" for w in prose(rng, 80).split())) for n in range(8)]
    found = {row.doc_id: row.kept for row in quality_rules.verdicts(
        documents(spark, clean + junk)).collect()}
    assert all(found[n] for n, _ in clean)
    assert not any(found[n] for n, _ in junk)


def test_odd_input(spark):
    docs = odd_documents(spark)
    found = collected(quality_rules.verdicts(docs))
    assert len(found) == docs.count()
    assert found == collected(quality_rules.verdicts(with_clashes(docs)))
    assert quality_rules.verdicts(empty(spark)).collect() == []
