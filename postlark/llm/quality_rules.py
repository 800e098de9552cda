"""Weak supervision of quality: rules vote or abstain, and EM weighs them.

Each rule looks at a few counts of a text and votes good (1) or bad (-1), or abstains (0).
Expectation-maximisation over the votes of the whole corpus estimates how often each rule votes
on good and on bad texts, and so how accurate it is. A text is kept if the posterior probability of good, given all
its votes, is at least one half. No rule has a veto.

The counts of a text are made in one pass over the texts and stored. The votes of all rows are
counted by pattern: at most 2 to the power of the number of rules, whatever the corpus, so EM on
those counts runs on the driver.

Edge cases: a null text has no words; a text without words abstains in every rule that needs one.
Repeated rows are judged alike. An empty table gives an empty result. Other columns of the input
are ignored, and a null id is passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlark.llm import words
from postlark.session import stored

COUNTS = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_distinct_words",
    "n_letters",
    "n_upper",
    "n_marks",
]
MIN_WORDS = 50

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b"!?")] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text of a batch."""
    out = {name: np.zeros(len(texts), dtype=np.int64) for name in COUNTS}
    for first, buf, offsets in words.chunks(texts):
        n = len(offsets) - 1
        own = slice(first, first + n)
        rows, starts, ends = words.word_spans(buf, offsets)
        hashes = words.span_hashes(buf, starts, ends)
        out["n_words"][own] = np.bincount(rows, minlength=n)
        code_points = ((buf & 0xC0) != 0x80) & ~words.SPACE[buf]
        for name, flags in (
            ("word_chars", code_points),
            ("n_symbols", _SYMBOL[buf]),
            ("n_letters", _LETTER[buf]),
            ("n_upper", _UPPER[buf]),
            ("n_marks", _MARK[buf]),
        ):
            out[name][own] = words.row_sums(flags, offsets)
        _, where = np.unique(words.with_row(hashes, rows), return_index=True)
        out["n_distinct_words"][own] = np.bincount(rows[where], minlength=n)
        out["n_repeat_words"][own] = np.bincount(rows[_in_repeats(hashes, rows)], minlength=n)
        out["n_dup_lines"][own] = np.bincount(_later_lines(buf, offsets, rows, starts), minlength=n)
    return out


def _in_repeats(hashes: np.ndarray, rows: np.ndarray, k: int = 3) -> np.ndarray:
    """Which words lie in a window of ``k`` words that its text has twice or more."""
    at, windows = words.window_hashes(hashes, rows, k)
    _, which, seen = np.unique(
        words.with_row(windows, rows[at]), return_inverse=True, return_counts=True
    )
    at = at[seen[which] > 1]
    covered = np.zeros(len(rows), dtype=bool)
    for j in range(k):
        covered[at + j] = True
    return covered


def _later_lines(
    buf: np.ndarray, offsets: np.ndarray, word_rows: np.ndarray, word_starts: np.ndarray
) -> np.ndarray:
    """Rows of the lines that have a word and equal an earlier line of their text."""
    breaks = np.flatnonzero(buf == 10)
    full = offsets[:-1][offsets[1:] > offsets[:-1]]
    starts = np.unique(np.concatenate([full, breaks + 1]))
    starts = starts[starts < len(buf)]
    ends = np.searchsorted(breaks, starts)
    next_break = np.append(breaks, len(buf))[ends]
    rows = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.minimum(next_break, offsets[1:][rows])
    with_words = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    rows, starts, ends = rows[with_words], starts[with_words], ends[with_words]
    lines = words.with_row(words.span_hashes(buf, starts, ends), rows)
    later = np.ones(len(lines), dtype=bool)
    later[np.unique(lines, return_index=True)[1]] = False
    return rows[later]


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and counts of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_counts(batch.column(1))
            arrays = [batch.column(0), *[pa.array(found[name]) for name in COUNTS]]
            yield pa.RecordBatch.from_arrays(arrays, names=[id_col, *COUNTS])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"`{id_col}` {kind}", *[f"{name} bigint" for name in COUNTS]])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _votes(value: int, when: Column) -> Column:
    """``value`` where the condition holds; the rule abstains elsewhere, and where it is unknown."""
    return F.when(when, value).otherwise(0)


def rules() -> dict[str, Column]:
    """The rules over the counts. Each votes one way only, or abstains."""
    per_word = lambda name: F.try_divide(F.col(name), F.col("n_words"))
    symbols, marks = per_word("n_symbols"), per_word("n_marks")
    repeats, variety = per_word("n_repeat_words"), per_word("n_distinct_words")
    mean_length = per_word("word_chars")
    upper = F.try_divide(F.col("n_upper"), F.col("n_letters"))
    return {
        "symbols": _votes(-1, symbols > 0.1),
        "symbol_share": _votes(-1, F.try_divide(F.col("n_symbols"), F.col("word_chars")) > 0.03),
        "marks": _votes(-1, marks > 0.2),
        "upper": _votes(-1, upper > 0.3),
        "repeats": _votes(-1, repeats > 0.3),
        "variety": _votes(-1, variety < 0.2),
        "word_length": _votes(-1, (mean_length < 2.5) | (mean_length > 12)),
        "dup_lines": _votes(-1, per_word("n_dup_lines") > 0.05),
        "short": _votes(-1, F.col("n_words") < 20),
        "natural": _votes(
            1,
            (variety > 0.35)
            & mean_length.between(3, 9)
            & (repeats < 0.2)
            & (symbols < 0.02)
            & (marks < 0.05)
            & (upper < 0.12),
        ),
    }


class LabelModel:
    """How often each rule casts its vote on bad and on good texts, found by EM."""

    def __init__(self, prior: float, rates: np.ndarray):
        self.prior = prior
        self.rates = rates  # rule, class (bad, good)

    @classmethod
    def fit(cls, votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
        """``votes``: a row for each pattern, a column for each rule; ``counts``: rows of it.

        The start takes a pattern for bad if any of its votes is bad. A class that no rule votes
        for twice cannot be told from noise by votes alone, so each class also holds imagined
        rows, a tenth of the corpus and ten more, in which rules are mostly right. They keep the
        classes in their places, and a rule that disagrees with the others still loses its weight.
        """
        side = np.where((votes > 0).any(axis=0), 1, -1)
        cast = votes != 0
        good = np.where((votes < 0).any(axis=1), 0.02, 0.98)
        imagined = 10 + 0.1 * counts.sum()
        guess = np.where(side[:, None] == np.array([-1, 1]), 0.3, 0.002)
        model = cls(0.5, guess)
        for _ in range(rounds):
            weights = np.stack([counts * (1 - good), counts * good])
            rates = (weights @ cast).T + imagined * guess
            rates /= weights.sum(axis=1) + imagined
            model = cls((weights[1].sum() + 1) / (counts.sum() + 2), rates)
            last, good = good, model.posterior(votes)
            if len(votes) == 0 or np.abs(good - last).max() < 1e-9:
                break
        return model

    def log_odds(self) -> tuple[float, np.ndarray, np.ndarray]:
        """Prior log odds of good, and what each rule adds when it votes and when it abstains."""
        start = float(np.log(self.prior) - np.log1p(-self.prior))
        bad, good = self.rates[:, 0], self.rates[:, 1]
        return start, np.log(good) - np.log(bad), np.log1p(-good) - np.log1p(-bad)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of good."""
        start, cast, abstained = self.log_odds()
        total = start + (votes != 0) @ cast + (votes == 0) @ abstained
        return 1 / (1 + np.exp(-np.clip(total, -700, 700)))


def fit(voted: DataFrame, names: list[str]) -> LabelModel:
    """Count the vote patterns of all rows and run EM on the counts."""
    patterns = voted.groupBy(*names).count().orderBy(*names).collect()
    votes = np.array([row[: len(names)] for row in patterns], dtype=int).reshape(-1, len(names))
    return LabelModel.fit(votes, np.array([row["count"] for row in patterns], dtype=float))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, counts, the vote of each rule (``vote_…``), and the posterior ``quality``."""
    voted = stored(
        counts(docs, id_col, text_col).select(
            "*", *[vote.cast("int").alias(f"vote_{name}") for name, vote in rules().items()]
        ),
        "quality-votes",
    )
    names = [f"vote_{name}" for name in rules()]
    start, cast, abstained = fit(voted, names).log_odds()
    total = F.lit(start)
    for name, vote, none in zip(names, cast.tolist(), abstained.tolist(), strict=True):
        total = total + F.when(F.col(name) != 0, vote).otherwise(none)
    return voted.withColumn("quality", 1 / (1 + F.exp(-total)))


def verdicts(docs: DataFrame) -> DataFrame:
    """Base counts, the base verdict and whether the text is kept."""
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    return judge(docs).select(
        "doc_id",
        *COUNTS[:5],
        failed.alias("base_failed"),
        (~failed & (F.col("quality") >= 0.5)).alias("kept"),
        "quality",
    )
