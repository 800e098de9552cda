import hashlib
import random

import pytest
from corpus import collected, documents, empty, odd_documents, with_clashes

from postlark.llm import line_dedup


def brute(rows):
    """Each text's lines that stay; the order is by id."""
    seen, out = {}, []
    places = []
    for number, text in sorted(rows):
        lines = text.split("\n")
        places += [(number, i, tuple(lines[i : i + 3]), lines) for i in range(len(lines) - 2)]
    for number, i, window, _ in places:
        if "".join(window).strip():
            seen.setdefault(window, (number, i))
    for number, text in sorted(rows):
        lines = text.split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            if window in seen and seen[window] != (number, i):
                gone |= {i, i + 1, i + 2}
        out.append((number, len(lines), len(gone), [x for i, x in enumerate(lines) if i not in gone]))
    return out


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh", ["a", "b", "", " "]])
def test_equals_a_plain_loop(spark, alphabet):
    rng = random.Random(9)
    rows = [
        (n, "\n".join(rng.choice(alphabet) for _ in range(rng.randint(1, 14)))) for n in range(60)
    ]
    expected = [
        (n, size, gone, hashlib.sha256("\n".join(stay).encode()).hexdigest())
        for n, size, gone, stay in brute(rows)
    ]
    assert collected(line_dedup.digest(documents(spark, rows))) == sorted(expected, key=repr)
    kept = {row.doc_id: row.text for row in line_dedup.deduplicated(documents(spark, rows)).collect()}
    assert kept == {n: "\n".join(stay) for n, _, _, stay in brute(rows) if stay}


def test_a_passage_stays_where_it_first_occurs(spark):
    passage = "p one\np two\np three\np four"
    rows = [(3, f"c\n{passage}\nd"), (1, f"a\n{passage}\nb"), (2, "p one\np two\nother")]
    kept = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.deduplicated(
        documents(spark, rows)).collect()}
    assert kept == {1: (rows[1][1], len(rows[1][1])), 2: (rows[2][1], len(rows[2][1])), 3: ("c\nd", 3)}


def test_odd_input(spark):
    docs = odd_documents(spark)
    found = line_dedup.deduplicated(docs)
    assert found.columns == docs.columns and found.count() == docs.count()
    wide = with_clashes(docs)
    again = line_dedup.deduplicated(wide)
    assert again.columns == wide.columns
    assert collected(again.select(docs.columns)) == collected(found)
    assert {row.n_lines for row in line_dedup.digest(docs).where("doc_id = 1").collect()} == {0}
    assert line_dedup.digest(empty(spark)).collect() == []
    repeated = documents(spark, [(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "a\nb\nc")])
    kept = collected(line_dedup.digest(repeated).select("doc_id", "n_removed"))
    assert kept == [(1, 0), (1, 0), (None, 3)]
