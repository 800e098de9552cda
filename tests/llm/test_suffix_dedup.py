import collections
import hashlib
import random

import numpy as np
import pytest
from corpus import collected, documents, empty, odd_documents, with_clashes

from postlark.llm import induced, suffix_dedup

LENGTH = suffix_dedup.LENGTH


def brute(rows):
    data = [(number, (text or "").encode()) for number, text in rows]
    seen = collections.Counter(
        own[i : i + LENGTH] for _, own in data for i in range(len(own) - LENGTH + 1)
    )
    out = []
    for number, own in data:
        gone = bytearray(len(own))
        for i in range(len(own) - LENGTH + 1):
            if seen[own[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        kept = bytes(c for c, g in zip(own, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((number, len(own), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    source = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    filler = lambda own: "".join(rng.choice(own) for _ in range(rng.randint(0, 300)))
    out = []
    for size in (199, 200, 201, 230, 264, 265, 400, 900):
        at = rng.randrange(15_000)
        for _ in range(rng.choice([2, 3])):
            text = filler("xyzuvw") + source[at : at + size] + filler("klmnop")
            out.append((len(out), text))
    texts = ["ab" * 400, "q" * 199, "q" * 200, "r" * 201, "t\0" * 150 + "é" * 150, source[:2000],
             source[500:900] + "中" * 30 + source[500:900], "", None]
    return out + [(1000 + n, text) for n, text in enumerate(texts)]


@pytest.mark.parametrize("most", [suffix_dedup.MAX_VARIANTS, 2])
def test_equals_a_count_of_all_strings(spark, rows, most):
    docs = documents(spark, rows).repartition(5)
    assert collected(suffix_dedup.digest(docs, most)) == brute(rows)


def test_equal_rows_are_separate_documents(spark):
    text = "".join(chr(97 + n * n % 26) + str(n) for n in range(150))
    docs = documents(spark, [(1, text), (1, text), (None, text[:250])])
    removed = collected(suffix_dedup.digest(docs).select("doc_id", "n_removed"))
    assert removed == [(1, len(text)), (1, len(text)), (None, 250)]


def test_odd_input(spark):
    docs = odd_documents(spark)
    found = collected(suffix_dedup.digest(docs))
    assert found == brute([(row.doc_id, row.text) for row in docs.collect()])
    assert found == collected(suffix_dedup.digest(with_clashes(docs)))
    assert suffix_dedup.digest(empty(spark)).collect() == []


def arrays(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        own = []
        for _ in range(rng.randint(1, 4)):
            own += [rng.randint(1, rng.choice([2, 3, 5])) for _ in range(rng.randint(1, 25))] + [0]
        yield np.array(own, dtype=np.int16)


def test_suffix_arrays_and_common_prefixes():
    for text in arrays(1, 200):
        array, tied = induced.suffix_array(text, 1000)
        expected = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert array.tolist() == expected and not len(tied)
        shared = induced.common_prefixes(text, array, tied, 128)
        for before, here in zip(expected, expected[1:], strict=False):
            n = 0
            while max(before, here) + n < len(text) and text[before + n] == text[here + n]:
                n += 1
            assert shared[here] == n


def test_order_to_a_depth_puts_equal_strings_side_by_side():
    for text in arrays(2, 200):
        depth = 4
        array, tied = induced.suffix_array(text, depth)
        assert sorted(array.tolist()) == list(range(len(text)))
        cut = [text[i : i + depth].tolist() for i in array]
        assert cut == sorted(cut)
        shared = induced.common_prefixes(text, array, tied, 128)
        for k in range(1, len(array)):
            if len(cut[k]) == depth:
                assert (shared[array[k]] >= depth) == (cut[k] == cut[k - 1])


def test_equal_rows_share_one_list_of_stretches(spark):
    text = "".join(chr(97 + n * n % 26) + str(n) for n in range(400))
    docs = documents(spark, [(None, text)] * 60 + [(7, text[100:900])])
    found = suffix_dedup.covered(docs).selectExpr("doc_id", "size(found) AS n").collect()
    sizes = {row.doc_id: row.n for row in found}
    once = suffix_dedup.covered(documents(spark, [(None, text), (7, text), (8, text[100:900])]))
    single = once.where("doc_id IS NULL").selectExpr("size(found) AS n").first().n
    assert sizes[None] == single
    assert collected(suffix_dedup.digest(docs)) == brute([(None, text)] * 60 + [(7, text[100:900])])


def test_strings_of_a_hot_anchor_are_cut_a_part_at_a_time():
    import numpy as np
    import pyarrow as pa

    data = np.arange(60_000, dtype=np.uint32).view(np.uint8)
    sizes = np.array([100_000, 200, 100_000])
    found = {
        "row": np.array([0, 1, 1]),
        "start": np.array([0, 100_000, 100_300]),
        "size": sizes,
        "at": np.array([0, 0, 300]),
        "anchor": np.array([5, 6, 7]),
    }
    batch = pa.RecordBatch.from_arrays([pa.array([8, 9]), pa.array([1, 2])], names=["doc_id", "hash"])
    parts = list(suffix_dedup._strings(batch, data, found))
    assert len(parts) > 10
    assert max(part.num_rows for part in parts) <= suffix_dedup.SENT_STRINGS
    rows = pa.Table.from_batches(parts).to_pylist()
    assert len(rows) == int((sizes - suffix_dedup.LENGTH + 1).sum())
    places = [(8, 5, n) for n in range(100_000 - 199)] + [(9, 6, 0)]
    places += [(9, 7, 300 + n) for n in range(100_000 - 199)]
    assert [(row["doc_id"], row["anchor"], row["at"]) for row in rows] == places
