"""Token counts of a unigram tokenizer, without making the tokens.

An Aho-Corasick automaton of the vocabulary finds every piece in a word in one pass. Dynamic
programming over the ends of pieces carries two numbers for each position: the best score of a path
to it, and the number of tokens on that path. Nothing is traced back.

The rules are those of the tokenizers library's unigram model behind its metaspace splitter, so the
counts are those of its ``encode``: scores are added from the left; among paths of equal score to a
position, the one whose last piece starts first wins; a character that is no piece costs the lowest
score less ten, and counts as its bytes if the vocabulary has byte pieces, otherwise a run of such
characters is one unknown token. Spaces become U+2581, one stands before the text, and each starts
a word.

The vocabulary is a list of pieces and scores, of a fixed size, and goes to the tasks as it is. Each
task keeps the counts of words it has met, up to a fixed number. Texts never leave their task.

Edge cases: a null or empty text has no tokens. A word of any length is counted in time linear in it
(times the longest piece). Equal rows get equal counts. An empty table gives an empty result. Other
columns are ignored, and a null id is passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
KEPT_WORDS = 400_000


def sentencepiece_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts the tokens of texts."""

    def __init__(self, vocabulary: list[tuple[str, float]], kept_words: int = KEPT_WORDS):
        self.automaton = ahocorasick.Automaton()
        pieces = dict(vocabulary)
        for piece, score in pieces.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        byte_pieces = [f"<0x{b:02X}>" in pieces for b in range(256)]
        if any(byte_pieces) and not all(byte_pieces):
            raise ValueError("a vocabulary needs all byte pieces or none")
        self.by_bytes = all(byte_pieces)
        self.kept: dict[str, int] = {}
        self.kept_words = kept_words

    def word(self, word: str) -> int:
        """Number of tokens on the best path through one word."""
        n = len(word)
        best: list[float] = [0.0] * (n + 1)
        tokens = [0] * (n + 1)
        unknown_end = [False] * (n + 1)
        found = self.automaton.iter(word)
        last, piece = next(found, (n, None))
        for end in range(1, n + 1):
            score = None
            single = False
            # Pieces that end here come longest first, so the first to start wins ties.
            while last == end - 1:
                size, value = piece
                single = single or size == 1
                total = value + best[end - size]
                if score is None or total > score:
                    score, start = total, end - size
                last, piece = next(found, (n, None))
            total = self.unknown + best[end - 1]
            if not single and (score is None or total > score):
                best[end] = total
                unknown_end[end] = True
                if self.by_bytes:
                    tokens[end] = tokens[end - 1] + len(word[end - 1].encode())
                else:
                    tokens[end] = tokens[end - 1] + (not unknown_end[end - 1])
            else:
                best[end] = score
                tokens[end] = tokens[start] + 1
        return tokens[n]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        parts = text.replace(SPACE, " ").split(" ")
        kept, total = self.kept, 0
        for part in parts[1:] if not parts[0] else parts:
            count = kept.get(part)
            if count is None:
                if len(kept) >= self.kept_words:
                    kept.clear()
                count = self.word(SPACE + part)
                if len(part) < 100:
                    kept[part] = count
            total += count
        return total


def counts(docs: DataFrame, vocabulary: list[tuple[str, float]]) -> DataFrame:
    """Id and number of tokens of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            found = [counter.text(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "n_tokens"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens bigint")
