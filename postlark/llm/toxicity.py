"""Toxicity by a small convolutional network over hashed word embeddings, trained in numpy.

Words are lower-cased runs of letters, digits and bytes above 127. A word and its beginnings of four
to eight bytes are hashed to rows of an embedding table, which are added up. Filters of several widths slide over the words of a whole text; each keeps its largest
response, and a logistic layer weighs these. Windows do not cross texts.

The threshold is set for each language on labelled texts that the network was not trained on, and
the score is shifted so that 0.5 is that threshold. The language is guessed from the text, by
common words; the table's own language column is not read. A language with few toxic texts takes
the threshold of all.

The fit takes every labelled row that may be learnt from, with its whole text. Words are counted in
all of them. The rows are dealt to shards of about ``shard_bytes`` of text; in each of ``ROUNDS``
rounds every shard trains the same network on its rows, and the mean of their steps is the next
one. Steps are added as whole numbers, so that the order of tasks does not matter. For the
thresholds the network's outputs are counted in steps of ``1 / STEPS``. Every row is scored on its
whole text. The network goes to the tasks in whole; its size is fixed.

Edge cases: a null text is empty, and an empty text has a score like any other. Without labelled
rows of both classes every row gets the share of the class that there is, or one half. An empty
table gives an empty result. Other columns are ignored, and a null id is passed on.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlark.llm import words
from postlark.llm.compression_classifier import (
    SHARD_BYTES,
    TURNS,
    class_sizes,
    held_out,
    labelled,
)
from postlark.session import discard, drop_shuffles

BUCKETS = 1 << 16
DIMENSIONS = 8
FILTERS = 12
WIDTHS = (1, 2, 3)
# Rounds of all shards, and passes over a shard in each.
ROUNDS = 2
EPOCHS = 3
# Texts of a batch, and words unless one text has more.
BATCH = 32
BATCH_WORDS = 1 << 16
RATE = 0.02
# The steps and the range of counted outputs, and the unit of added steps.
STEPS, WIDEST = 256, 64
UNIT = 2.0**30
FEW = 15
RARE = 5
BEGINNINGS = (4, 5, 6, 7, 8)

# Common words by which a language is guessed.
COMMON_WORDS = {
    "en": "the of and to in is that it was for on are with as be this have from or by",
    "fr": "le la les des et un une du est que qui dans pour pas sur au avec ne se ce",
    "es": "el la los las de y que en un una por con para su se lo del al como más",
    "de": "der die und das den von zu mit ist des im für nicht ein eine auch dem es sich auf",
}

_SEPARATOR = np.ones(256, dtype=bool)
_SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def word_ids(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of texts as (first row, hashes of words, table rows of words, bounds of each text)."""
    for first, buf, offsets in words.chunks(texts):
        low = words.LOWER[buf]
        low[_SEPARATOR[buf]] = 32
        rows, starts, ends = words.word_spans(low, offsets)
        hashes = words.span_hashes(low, starts, ends)
        ids = np.full((len(hashes), 1 + len(BEGINNINGS)), BUCKETS, dtype=np.int32)
        ids[:, 0] = hashes % np.uint64(BUCKETS)
        for k, size in enumerate(BEGINNINGS, 1):
            long = np.flatnonzero(ends - starts > size)
            own = words.span_hashes(low, starts[long], starts[long] + size)
            ids[long, k] = words.mix(own + np.uint64(size)) % np.uint64(BUCKETS)
        yield first, hashes, ids, np.searchsorted(rows, np.arange(len(offsets)))


def _hash(word: str) -> int:
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(words.span_hashes(data, np.array([0]), np.array([len(data)]))[0])


def languages(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The language with the most common words in each text; without any, the first."""
    hits = np.zeros((len(bounds) - 1, len(COMMON_WORDS)), dtype=np.int64)
    for i, listed in enumerate(COMMON_WORDS.values()):
        known = np.array([_hash(word) for word in listed.split()], dtype=np.uint64)
        sums = np.concatenate([[0], np.cumsum(np.isin(hashes, known))])
        hits[:, i] = sums[bounds[1:]] - sums[bounds[:-1]]
    return hits.argmax(axis=1)


@dataclass
class Network:
    """Embeddings, filters for each width (width, dimension, filter), and the last layer."""

    table: np.ndarray
    filters: list[np.ndarray]
    offsets: list[np.ndarray]
    weights: np.ndarray
    bias: float
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(COMMON_WORDS)))

    @classmethod
    def fresh(cls, first: np.ndarray, seed: int = 7) -> Network:
        """Random, but for the first dimension of the embeddings and filters that read it."""
        rng = np.random.default_rng(seed)
        table = rng.normal(0, 0.05, (BUCKETS + 1, DIMENSIONS)).astype(np.float32)
        table[:BUCKETS, 0] = first
        table[BUCKETS] = 0
        filters = [
            rng.normal(0, 0.3, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS
        ]
        for own in filters:
            own[:, 0, : FILTERS // 2] = 0.7
            own[:, 0, FILTERS // 2 :] = -0.7
        offsets = [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS]
        return cls(table, filters, offsets, np.zeros(len(WIDTHS) * FILTERS, dtype=np.float32), 0.0)

    def padded(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Table rows of all texts, each followed by empty words, and where each starts."""
        sizes = np.diff(bounds)
        starts = bounds[:-1] + max(WIDTHS) * np.arange(len(sizes))
        out = np.full((len(ids) + max(WIDTHS) * len(sizes), ids.shape[1]), BUCKETS, dtype=np.int32)
        out[np.arange(len(ids)) + np.repeat(starts - bounds[:-1], sizes)] = ids
        return out, starts

    def embedded(self, ids: np.ndarray) -> np.ndarray:
        out = self.table[ids[..., 0]]
        for k in range(1, ids.shape[-1]):
            out += self.table[ids[..., k]]
        return out

    def responses(self, ids: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """Each filter at each place; places from which a window would leave its text are out."""
        rows = self.embedded(ids)
        ends = np.append(starts[1:], len(ids))
        found = []
        for width, own, offset in zip(WIDTHS, self.filters, self.offsets, strict=True):
            out = np.full((len(ids), FILTERS), -np.inf, dtype=np.float32)
            n = len(ids) - width + 1
            out[:n] = offset
            for k in range(width):
                out[:n] += rows[k : k + n] @ own[k]
            for k in range(1, width):
                out[ends - k] = -np.inf
            found.append(out)
        return found

    def logits(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        ids, starts = self.padded(ids, bounds)
        tops = [np.maximum.reduceat(out, starts, axis=0) for out in self.responses(ids, starts)]
        return np.maximum(np.concatenate(tops, axis=1), 0) @ self.weights + self.bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        for first, hashes, ids, bounds in word_ids(texts):
            z = self.logits(ids, bounds) - self.thresholds[languages(hashes, bounds)]
            out[first : first + len(z)] = 1 / (1 + np.exp(-np.clip(z.astype(float), -700, 700)))
        return out

    def train(self, docs: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS) -> None:
        """Stochastic gradient steps with per-parameter rates, over shuffled batches."""
        rng = np.random.default_rng(11)
        dense = [*self.filters, *self.offsets, self.weights]
        seen = [np.full_like(p, 1e-4) for p in dense]
        table_seen = np.full_like(self.table, 1e-4)
        bias_seen = 1e-4
        for _ in range(epochs):
            for batch in _batches(rng.permutation(len(docs)), docs):
                sizes = [len(docs[i]) for i in batch]
                bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                ids, starts = self.padded(np.concatenate([docs[i] for i in batch]), bounds)
                found = self.responses(ids, starts)
                ends = np.append(starts[1:], len(ids))
                places = [
                    np.stack([out[a:b].argmax(axis=0) + a
                              for a, b in zip(starts, ends, strict=True)])
                    for out in found
                ]
                columns = np.arange(FILTERS)[None, :]
                tops = [out[p, columns] for out, p in zip(found, places, strict=True)]
                pooled = np.maximum(np.concatenate(tops, axis=1), 0)
                z = np.clip(pooled @ self.weights + self.bias, -30, 30)
                error = ((1 / (1 + np.exp(-z)) - y[batch]) / len(batch)).astype(np.float32)
                back = error[:, None] * self.weights[None, :] * (pooled > 0)
                grads_f, grads_o, table_ids, table_grads = [], [], [], []
                for k, (width, own, place) in enumerate(zip(WIDTHS, self.filters, places,
                                                            strict=True)):
                    g = back[:, k * FILTERS : (k + 1) * FILTERS]
                    grad = np.zeros_like(own)
                    for j in range(width):
                        touched = ids[np.minimum(place + j, len(ids) - 1)]
                        grad[j] = np.einsum("df,dfe->ef", g, self.embedded(touched))
                        moved = (g[:, :, None] * own[j].T[None]).reshape(-1, DIMENSIONS)
                        table_ids.append(touched.ravel())
                        table_grads.append(np.repeat(moved, touched.shape[-1], axis=0))
                    grads_f.append(grad)
                    grads_o.append(g.sum(axis=0))
                self._step(dense, seen, [*grads_f, *grads_o, pooled.T @ error])
                bias_seen += float(error.sum()) ** 2
                self.bias -= RATE * float(error.sum()) / bias_seen**0.5
                own, which = np.unique(np.concatenate(table_ids), return_inverse=True)
                summed = np.zeros((len(own), DIMENSIONS), dtype=np.float32)
                np.add.at(summed, which, np.concatenate(table_grads))
                summed[own == BUCKETS] = 0
                table_seen[own] += summed**2
                self.table[own] -= RATE * summed / np.sqrt(table_seen[own])

    def parameters(self) -> np.ndarray:
        """All that is trained, as rows of ``DIMENSIONS`` numbers: the table, then the others."""
        parts = [*self.filters, *self.offsets, self.weights, np.array([self.bias])]
        others = np.concatenate([part.ravel() for part in parts]).astype(float)
        others = np.append(others, np.zeros(-len(others) % DIMENSIONS))
        return np.concatenate([self.table.astype(float), others.reshape(-1, DIMENSIONS)])

    def with_parameters(self, rows: np.ndarray) -> Network:
        out = copy.deepcopy(self)
        out.table = rows[: len(self.table)].astype(np.float32)
        others, at = rows[len(self.table) :].ravel(), 0
        for part in [*out.filters, *out.offsets, out.weights]:
            part[...] = others[at : at + part.size].reshape(part.shape)
            at += part.size
        out.bias = float(others[at])
        return out

    @staticmethod
    def _step(params, seen, grads) -> None:
        for p, s, g in zip(params, seen, grads, strict=True):
            s += g * g
            p -= RATE * g / np.sqrt(s)


def _batches(order: np.ndarray, docs: list[np.ndarray]) -> Iterator[np.ndarray]:
    first = n = 0
    for at, i in enumerate(order):
        if at - first == BATCH or (at > first and n + len(docs[i]) > BATCH_WORDS):
            yield order[first:at]
            first, n = at, 0
        n += len(docs[i])
    if len(order):
        yield order[first:]


def _word_texts(rows: DataFrame) -> np.ndarray:
    """The number of texts of each class, 0 and 1, with a word of each table row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            label = batch.column(0).to_numpy()
            for first, _, ids, bounds in word_ids(batch.column(1)):
                row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                found = np.unique((row[:, None] * (BUCKETS + 1) + ids).ravel())
                row, own = found // (BUCKETS + 1), found % (BUCKETS + 1)
                row, own = row[own < BUCKETS], own[own < BUCKETS]
                for value in (0, 1):
                    here = own[label[first + row] == value]
                    seen[value] += np.bincount(here, minlength=BUCKETS)
        value, own = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(value.astype(np.int32)), pa.array(own.astype(np.int32)), pa.array(seen[value, own])],
            names=["label", "own", "n"],
        )

    counts = rows.select("label", "text").mapInArrow(run, "label int, own int, n bigint")
    found = counts.groupBy("label", "own").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((2, BUCKETS))
    out[found["label"].to_numpy(), found["own"].to_numpy()] = found["n"].to_numpy()
    return out


def _log_odds(seen: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How much a word's presence speaks for the class 1, by bucket; nothing for rare words.

    A word of a few texts would only tell the network which texts it has seen.
    """
    sizes = sizes + 1.0
    rates = (seen + 4 * sizes[:, None] / sizes.sum()) / sizes[:, None]
    known = seen.sum(axis=0) >= RARE
    return np.where(known, np.log(rates[1] / rates[0]), 0).astype(np.float32)


def _trained(rows: DataFrame, network: Network) -> Network:
    """The network after a round: the mean of the steps that the shards' rows make."""
    shared = rows.sparkSession.sparkContext.broadcast(network)
    names = [f"d{i}" for i in range(DIMENSIONS)]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("turn", "ascending"), ("label", "ascending")])
        docs = []
        for _, _, ids, bounds in word_ids(table["text"].combine_chunks()):
            docs += [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        before, own = shared.value.parameters(), copy.deepcopy(shared.value)
        own.train(docs, table["label"].to_numpy().astype(np.float32))
        steps = np.rint((own.parameters() - before) * UNIT).astype(np.int64)
        at = np.flatnonzero(steps.any(axis=1))
        arrays = [pa.array(at), *[pa.array(steps[at, i]) for i in range(DIMENSIONS)]]
        return pa.table(arrays, names=["at", *names])

    schema = ", ".join(f"{name} bigint" for name in ["at", *names])
    steps = rows.groupBy("shard").applyInArrow(run, schema)
    found = steps.groupBy("at").agg(
        F.count("*").alias("n"), *[F.sum(name).alias(name) for name in names]
    ).toArrow()
    # A word's row takes the mean of the shards that have moved it.
    mean = np.stack([found[name].to_numpy() for name in names], axis=1)
    mean = mean / UNIT / found["n"].to_numpy()[:, None]
    after = network.parameters()
    after[found["at"].to_numpy()] += mean
    shared.destroy()
    drop_shuffles(rows.sparkSession)
    return network.with_parameters(after)


def _output_counts(rows: DataFrame, network: Network) -> pa.Table:
    """``spoken``, ``step`` of the output, ``n`` and ``hits``: rows and those of class 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, ids, bounds in word_ids(batch.column(1)):
                z = np.clip(network.logits(ids, bounds).astype(float), -WIDEST, WIDEST)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(z)),
                        pa.array(np.floor(z * STEPS).astype(np.int32)),
                        pa.array(languages(hashes, bounds).astype(np.int32)),
                    ],
                    names=["label", "step", "spoken"],
                )

    steps = rows.select("label", "text").mapInArrow(run, "label int, step int, spoken int")
    return steps.groupBy("spoken", "step").agg(
        F.count("*").alias("n"), F.sum("label").alias("hits")
    ).toArrow()


def threshold(step: np.ndarray, n: np.ndarray, hits: np.ndarray) -> float:
    """The cut between outputs with the best F1 on the class 1, in the middle of its gap."""
    steps, place = np.unique(step, return_inverse=True)
    z = (steps[::-1] + 0.5) / STEPS
    n, hits = (np.bincount(place, x, minlength=len(z))[::-1] for x in (n, hits))
    f1 = 2 * np.cumsum(hits) / (np.cumsum(n) + hits.sum())
    i = int(f1.argmax())
    below = z[i + 1] if i + 1 < len(z) else z[i] - 1
    return float((z[i] + below) / 2)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    id_col: str = "doc_id",
    shard_bytes: int = SHARD_BYTES,
) -> Network:
    """Three quarters of the labelled rows train the network, the others set the thresholds."""
    rows, _ = labelled(docs, labels, label, id_col, shard_bytes)
    sizes, kept = class_sizes(rows)
    if not sizes.all():
        discard(rows)
        share = (sizes[1] + 1) / (sizes.sum() + 2)
        network = Network.fresh(np.zeros(BUCKETS, dtype=np.float32))
        network.bias = float(np.log(share / (1 - share)))
        return network
    used = rows.where(F.col("turn") % TURNS > 0)
    network = Network.fresh(_log_odds(_word_texts(used), sizes - kept))
    for _ in range(ROUNDS):
        network = _trained(used, network)
    found = _output_counts(rows.where(F.col("turn") % TURNS == 0), network)
    discard(rows)
    spoken, step, n, hits = (found[x].to_numpy() for x in ("spoken", "step", "n", "hits"))
    everywhere = threshold(step, n, hits)
    for i in range(len(COMMON_WORDS)):
        here = spoken == i
        enough = min(hits[here].sum(), (n - hits)[here].sum()) >= FEW
        network.thresholds[i] = threshold(step[here], n[here], hits[here]) if enough else everywhere
    return network


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Id, whether the row is held out, score and prediction."""
    network = fit(docs, labels)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(network.scores(batch.column(1)), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
