import numpy as np
import pyarrow as pa
from corpus import LOWER, words as plain_words

from postlark.llm import words

TEXTS = ["a bb  ccc", "", None, "\tx\n y\x0b\x0cz\r", "é 中文  b", "a a a a", "bb", "A a"]


def test_spans_are_the_words():
    found = [[] for _ in TEXTS]
    for first, buf, offsets in words.chunks(pa.array(TEXTS)):
        rows, starts, ends = words.word_spans(buf, offsets)
        for row, a, b in zip(rows, starts, ends, strict=True):
            found[first + row].append(buf[a:b].tobytes().decode())
    assert found == [plain_words(text) for text in TEXTS]


def test_hashes_depend_on_the_word_alone():
    seen = {}
    for size in (4, 1 << 20):
        for _, buf, offsets in words.chunks(pa.array(TEXTS), size):
            rows, starts, ends = words.word_spans(buf, offsets)
            hashes = words.span_hashes(buf, starts, ends)
            for a, b, h in zip(starts, ends, hashes, strict=True):
                assert seen.setdefault(buf[a:b].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)


def test_windows_stay_in_their_text():
    hashes = np.array([1, 2, 3, 1, 2, 3, 4], dtype=np.uint64)
    rows = np.array([0, 0, 0, 1, 1, 1, 1])
    at, found = words.window_hashes(hashes, rows, 3)
    assert at.tolist() == [0, 3, 4]
    assert found[0] == found[1] != found[2]


def test_a_text_longer_than_a_chunk_is_taken_whole():
    texts = ["a b", "c " * 500, "d"]
    sizes = [len(buf) for _, buf, _ in words.chunks(pa.array(texts), 100)]
    assert sizes == [3, 1000, 1]


def test_slices_of_arrays():
    whole = pa.array(TEXTS).slice(3, 3)
    (chunk,) = list(words.chunks(whole))
    assert chunk[0] == 0 and len(chunk[2]) == 4
