"""Byte-level BPE encoding and decoding by a table of distinct words.

Spark splits every text into the tokenizer's words, and counts the distinct words of the corpus
with map-side combining. Each distinct word that occurs again is encoded once, on the executors,
and ids are joined back by position: the words of a batch look up their row in the table, and the
rows' ids are laid end to end.

The table is broadcast, so it is bounded: at most ``max_words`` words, the most frequent ones, of at
most ``MAX_WORD_BYTES`` bytes each. A word that is not in it is encoded where it is met, once in a
batch. A word that occurs once has nothing to share, so it is not in the table either. Sending
such words through a shuffle instead would move the texts too, as nearly every text has one.

Decoding joins ids with their pieces of bytes, a table as long as the vocabulary, and puts the
bytes of a text together as UTF-8, with U+FFFD for what is not valid.

Special tokens in a text are single words, as the tokenizers library takes them.

Edge cases: a null text is empty and gets no ids. Equal rows are encoded alike. An empty table gives
an empty result. Other columns are ignored, and a null id is passed on.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from postlark.session import stored

# Bounds of the broadcast table.
MAX_TABLE_WORDS = 1 << 18
MAX_WORD_BYTES = 32

_ID = np.dtype("<u4")
_AT_ONCE = 2048


def split_pattern(specials: list[str]) -> str:
    """The byte-level tokenizer's words as a Java pattern, special tokens first.

    A special token ends the text before it: no word runs into it, and white space before it is
    white space at an end.
    """
    quoted = ["".join(f"\\x{{{ord(c):x}}}" for c in token) for token in specials]
    special = "(?:" + "|".join(sorted(quoted, key=len, reverse=True)) + ")"
    ahead = f"(?!{special})" if specials else ""
    parts = [
        special if specials else "",
        "'s|'t|'re|'ve|'m|'ll|'d",
        r" ?\p{L}+",
        r" ?\p{N}+",
        rf" ?(?:{ahead}[^\s\p{{L}}\p{{N}}])+",
        rf"\s+(?={special})" if specials else "",
        r"\s+(?!\S)",
        r"\s+",
    ]
    # Java counts only ASCII white space as such unless told so.
    return "(?U)" + "|".join(part for part in parts if part)


class Vocabulary:
    """What is needed of a ``tokenizers`` file: its text, special tokens, and pieces by id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.text = file.read()
        loaded = json.loads(self.text)
        self.specials = {t["content"]: t["id"] for t in loaded["added_tokens"]}
        letters = {ord(c): b for b, c in _byte_letters().items()}
        by_id = {i: bytes(letters[ord(c)] for c in w) for w, i in loaded["model"]["vocab"].items()
                 if w not in self.specials}
        by_id |= {i: w.encode() for w, i in self.specials.items()}
        self.pieces = [by_id.get(i, b"") for i in range(max(by_id) + 1)]

    def pattern(self) -> str:
        return split_pattern(list(self.specials))

    def encoder(self) -> Tokenizer:
        """Encodes single words: special tokens are ordinary text, and nothing is split."""
        # A task has one core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_str(self.text)
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        tokenizer.encode_special_tokens = True
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves and others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


def words(text: Column, vocabulary: Vocabulary) -> Column:
    """The array of words of a text; nothing of the text is lost."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(vocabulary.pattern()), F.lit(0))


def _ids(own: list[str], encoder: Tokenizer, specials: dict[str, int]) -> list[bytes]:
    """The packed ids of each word, a few words at a time, as their encodings are large."""
    out = []
    for first in range(0, len(own), _AT_ONCE):
        some = own[first : first + _AT_ONCE]
        found = encoder.encode_batch(some, add_special_tokens=False)
        out += [
            np.array([specials[word]] if word in specials else one.ids, dtype=_ID).tobytes()
            for word, one in zip(some, found, strict=True)
        ]
    return out


def word_table(
    docs: DataFrame, vocabulary: Vocabulary, max_words: int = MAX_TABLE_WORDS
) -> DataFrame:
    """The most frequent words that occur at least twice, each with its ids, encoded once."""
    counted = stored(
        docs.select(F.explode(words(F.col("text"), vocabulary)).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where((F.col("n") > 1) & (F.octet_length("word") <= MAX_WORD_BYTES)),
        "bpe-words",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.encoder()
        for batch in batches:
            packed = _ids(batch.column(0).to_pylist(), encoder, vocabulary.specials)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary())], names=["word", "ids"]
            )

    return frequent(counted, max_words).select("word").mapInArrow(run, "word string, ids binary")


def frequent(counted: DataFrame, max_words: int) -> DataFrame:
    """Words above a count, which is set so that at most ``max_words`` are.

    The cut comes from the number of words of each step of counts, a few hundred steps at most.
    """
    step = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    sizes = counted.groupBy(step.alias("step")).count().collect()
    left, cut = max_words, 1 << 30
    for row in sorted(sizes, key=lambda row: -row["step"]):
        left -= row["count"]
        if left < 0:
            break
        cut = row["step"]
    return counted.where(step >= cut)


class IdTable:
    """Words with their ids, in Arrow form, to look up many words at once."""

    def __init__(self, table: pa.Table):
        self.words = pa.concat_arrays([pa.array([], pa.string()), *_flat(table["word"])])
        packed = pa.concat_arrays([pa.array([], pa.binary()), *_flat(table["ids"])])
        bounds = np.frombuffer(packed.buffers()[1], dtype=np.int32)[: len(packed) + 1]
        self.bounds = bounds.astype(np.int64) // _ID.itemsize
        data = packed.buffers()[2]
        self.ids = np.frombuffer(data or b"", dtype=_ID)

    def ids_of(self, own: pa.Array, encode) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each word end to end, and their bounds; ``encode`` makes missing ones."""
        at = pc.fill_null(pc.index_in(own, value_set=self.words), -1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(at < 0)
        made = encode(own.take(pa.array(missing)).to_pylist())
        more = np.frombuffer(b"".join(made), dtype=_ID)
        ends = np.cumsum([len(ids) // _ID.itemsize for ids in made], dtype=np.int64)
        known = np.flatnonzero(at >= 0)
        found, found_ends = _ragged(self.ids, self.bounds, at[known])
        place = np.empty(len(at), dtype=np.int64)
        place[known] = np.arange(len(known))
        place[missing] = len(known) + np.arange(len(missing))
        bounds = np.concatenate([found_ends, found_ends[-1] + ends])
        return _ragged(np.concatenate([found, more]), bounds, place)


def _flat(column: pa.ChunkedArray) -> list[pa.Array]:
    return column.chunks


def _ragged(values: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple:
    """The values of the given rows end to end, and the bounds of the result."""
    sizes = bounds[rows + 1] - bounds[rows]
    ends = np.zeros(len(rows) + 1, dtype=np.int64)
    np.cumsum(sizes, out=ends[1:])
    at = np.arange(ends[-1]) - np.repeat(ends[:-1] - bounds[rows], sizes)
    return values[at], ends


class Pieces:
    """The bytes of each id."""

    def __init__(self, pieces: list[bytes]):
        self.bounds = np.zeros(len(pieces) + 1, dtype=np.int64)
        np.cumsum([len(p) for p in pieces], out=self.bounds[1:])
        self.data = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        data, _ = _ragged(self.data, self.bounds, ids.astype(np.int64))
        return data.tobytes().decode("utf-8", errors="replace")


def _arrow_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


# Texts whose words are looked up at a time, and whose ids are laid out at a time.
_LOOKED_UP = 2048
_SLICE = 256


def _digests(split: pa.ListArray, table: IdTable, pieces: Pieces, encode) -> tuple[list, ...]:
    """Number of ids, hash of the ids and hash of the decoded text, of each list of words."""
    flat = pc.dictionary_encode(split.flatten())
    own, own_bounds = table.ids_of(flat.dictionary, encode)
    codes = flat.indices.to_numpy()
    offsets = split.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    sizes, id_hashes, text_hashes = [], [], []
    for first in range(0, len(split), _SLICE):
        bounds = offsets[first : first + _SLICE + 1]
        ids, ends = _ragged(own, own_bounds, codes[bounds[0] : bounds[-1]])
        ends = ends[bounds - bounds[0]]
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            sizes.append(b - a)
            id_hashes.append(hashlib.sha256(ids[a:b].tobytes()).hexdigest())
            text_hashes.append(hashlib.sha256(pieces.decode(ids[a:b]).encode()).hexdigest())
    return sizes, id_hashes, text_hashes


def encode(docs: DataFrame, vocabulary: Vocabulary, max_words: int = MAX_TABLE_WORDS) -> DataFrame:
    """Id, number of ids, and hashes of the ids and of the decoded text, for every row."""
    docs = docs.select("doc_id", "text")
    table = word_table(docs, vocabulary, max_words).toArrow()
    # At most ``max_words`` words of at most ``MAX_WORD_BYTES`` bytes, with their ids.
    shared = docs.sparkSession.sparkContext.broadcast(_arrow_bytes(table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pieces = vocabulary.encoder(), Pieces(vocabulary.pieces)
        ids_of = IdTable(pa.ipc.open_stream(shared.value).read_all())

        def encode_words(own: list[str]) -> list[bytes]:
            return _ids(own, encoder, vocabulary.specials)

        for batch in batches:
            for first in range(0, batch.num_rows, _LOOKED_UP):
                some = batch.slice(first, _LOOKED_UP)
                found = _digests(some.column(1), ids_of, pieces, encode_words)
                arrays = [pa.array(found[0], pa.int64()), *map(pa.array, found[1:])]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), *arrays],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
                pa.default_memory_pool().release_unused()

    split = docs.select("doc_id", words(F.col("text"), vocabulary).alias("words"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return split.mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
