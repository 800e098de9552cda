"""Quality by compression: which of two dictionaries packs a text better.

Labelled texts of each class train a zstandard dictionary. Whole texts are cut into blocks, so
that a dictionary counts as much at the end of a long text as at its start, and each block is
packed with both. The difference of the packed sizes, relative to the text's size, becomes a
probability by logistic calibration on labelled texts that trained no dictionary.

The fit takes every labelled row that may be learnt from, with its whole text. These rows are dealt to
shards of about ``shard_bytes`` of text. Each shard trains a dictionary of each class; up to
``MERGED`` of them at a time are the texts on which the next one is trained, until one is left. For
the calibration the differences are counted in steps of ``1 / STEPS``. Only the last two dictionaries
and these counts, of bounded size, reach the driver. Every row is scored on its whole text.

Edge cases: a null text is empty, and an empty text has no difference. Without labelled rows of
both classes every row gets the share of the class that there is, or one half. Repeated labels of
one id count once each. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from postlark.llm import sieve
from postlark.llm.rows import small_batches
from postlark.session import discard, drop_shuffles, stored

SHARD_BYTES = 8 << 20
# One row in so many of each class is kept for calibration.
TURNS = 4
# Dictionaries that are merged at a time, and the steps and the range of counted differences.
MERGED = 16
STEPS, WIDEST = 4096, 4
DICT_BYTES = 112 << 10
BLOCK_BYTES = 4 << 10
LEVEL = 3


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose label is never learnt from; a null id is among them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


@dataclass
class Model:
    """Dictionaries of bad and good text; probability = logistic(slope * difference + offset)."""

    bad: bytes
    good: bytes
    slope: float
    offset: float

    def differences(self, texts: list[bytes]) -> np.ndarray:
        """(bytes packed with bad - bytes packed with good) / bytes, for each text."""
        if not self.bad or not self.good:
            return np.zeros(len(texts))
        packers = [
            zstandard.ZstdCompressor(
                level=LEVEL,
                dict_data=zstandard.ZstdCompressionDict(data),
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
            for data in (self.bad, self.good)
        ]
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            packed = [0, 0]
            for at in range(0, len(text), BLOCK_BYTES):
                block = text[at : at + BLOCK_BYTES]
                for c, packer in enumerate(packers):
                    packed[c] += len(packer.compress(block))
            out[i] = (packed[0] - packed[1]) / len(text) if text else 0.0
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        z = self.slope * self.differences(texts) + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def dictionary(texts: list[bytes]) -> bytes:
    """A zstandard dictionary, or the texts themselves if there are too few to train one."""
    blocks = [t[i : i + BLOCK_BYTES] for t in texts for i in range(0, len(t), BLOCK_BYTES)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICT_BYTES:]


def logistic(
    x: np.ndarray, y: np.ndarray, n: np.ndarray | None = None, rounds: int = 100
) -> tuple[float, float]:
    """Slope and offset of a slightly damped logistic regression, by Newton steps.

    ``n`` says how often each pair occurs.
    """
    n = np.ones(len(x)) if n is None else n
    scale = float(np.sqrt(np.average((x - np.average(x, weights=n)) ** 2, weights=n))) or 1.0
    a = np.stack([x / scale, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(
            (a * (n * p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(2),
            a.T @ (n * (y - p)) - 0.01 * w,
        )
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, id_col: str, shard_bytes: int
) -> tuple[DataFrame, int]:
    """``shard``, ``turn``, ``label``, ``text`` of all rows that may be learnt from; number of shards.

    ``turn`` numbers the rows of a class in a shard. Rows are dealt and numbered by hashes of id and
    text, so that neither files nor machines change them. A bitmap of fixed size keeps most texts
    without a label out of the join.
    """
    spark = docs.sparkSession
    known = labels.where(~held_out(id_col) & F.col(label).isin(0, 1)).select(
        id_col, F.col(label).cast("int").alias("label")
    )
    texts = docs.where(~held_out(id_col) & (F.col("text") != "")).select(id_col, "text")
    # Labelled texts are taken to be as long as others.
    size = texts.agg(F.avg(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-int(size * known.count()) // shard_bytes))
    place = F.xxhash64(id_col)
    bitmap = spark.sparkContext.broadcast(sieve.sieve(known.select(place.alias("place"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passed = sieve.passes(batch.column(2).to_numpy(), bitmap.value)
            yield batch.filter(pa.array(passed)).select([0, 1])

    with small_batches(spark):
        return _dealt(texts.select("*", place).mapInArrow(run, texts.schema), known, shards), shards


def _dealt(texts: DataFrame, known: DataFrame, shards: int) -> DataFrame:
    id_col = known.columns[0]
    place = F.xxhash64(id_col)
    rows = texts.join(known.hint("merge"), id_col).select(
        F.pmod(F.xxhash64(place, "text"), F.lit(shards)).alias("shard"),
        place.alias("place"),
        id_col,
        "label",
        "text",
    )
    own = Window.partitionBy("shard", "label").orderBy("place", id_col, "text")
    rows = rows.withColumn("turn", F.row_number().over(own) - 1)
    out = stored(rows.select("shard", "turn", "label", "text"), "labelled")
    drop_shuffles(out.sparkSession)
    return out


def class_sizes(rows: DataFrame) -> np.ndarray:
    """Rows of each class: all of them, and those kept for calibration."""
    found = rows.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(F.col("turn") % TURNS == 0).alias("kept")
    )
    out = np.zeros((2, 2))
    for row in found.collect():
        out[:, row["label"]] = row["n"], row["kept"]
    return out


def dictionaries(rows: DataFrame, shards: int) -> tuple[bytes, bytes]:
    """The dictionaries of bad and good text, from all rows that are not kept for calibration."""

    def trained(table: pa.Table) -> pa.Table:
        table = table.sort_by("turn")
        made = []
        for value in (0, 1):
            texts = table.filter(pc.equal(table["label"], value))["text"].to_pylist()
            if texts:
                made.append((value, table["shard"][0].as_py(), dictionary([t.encode() for t in texts])))
        return _parts(made)

    def merged(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        data = table["data"].to_pylist()
        own = data[0] if len(data) == 1 else dictionary(data)
        return _parts([(table["label"][0].as_py(), table["into"][0].as_py(), own)])

    schema = "label int, part bigint, data binary"
    used = rows.where(F.col("turn") % TURNS > 0)
    parts = stored(used.groupBy("shard").applyInArrow(trained, schema), "dictionaries")
    while shards > 1:
        shards = -(-shards // MERGED)
        into = parts.withColumn("into", F.col("part") % shards)
        fewer = stored(into.groupBy("label", "into").applyInArrow(merged, schema), "dictionaries")
        discard(parts)
        parts = fewer
    found = {row["label"]: bytes(row["data"]) for row in parts.collect()}
    discard(parts)
    return found.get(0, b""), found.get(1, b"")


def _parts(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    kinds = (pa.int32(), pa.int64(), pa.binary())
    arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
    return pa.table(arrays, names=["label", "part", "data"])


def _difference_counts(rows: DataFrame, model: Model) -> tuple[np.ndarray, ...]:
    """Differences, classes, and how many rows have both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = model.differences([t.encode() for t in batch.column(1).to_pylist()])
            step = np.rint(np.clip(x, -WIDEST, WIDEST) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(step)], names=["label", "step"])

    steps = rows.select("label", "text").mapInArrow(run, "label int, step int")
    found = steps.groupBy("label", "step").count().orderBy("step", "label").toArrow()
    x, y, n = (found[name].to_numpy().astype(float) for name in ("step", "label", "count"))
    return x / STEPS, y, n


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_col: str = "doc_id",
    shard_bytes: int = SHARD_BYTES,
) -> Model:
    """Three quarters of the labelled rows train the dictionaries, the others calibrate."""
    rows, shards = labelled(docs, labels, label, id_col, shard_bytes)
    sizes, kept = class_sizes(rows)
    if not sizes.all():
        discard(rows)
        share = (sizes[1] + 1) / (sizes.sum() + 2)
        return Model(b"", b"", 0.0, float(np.log(share / (1 - share))))
    model = Model(*dictionaries(rows, shards), 0.0, 0.0)
    x, y, n = _difference_counts(rows.where(F.col("turn") % TURNS == 0), model)
    model.slope, offset = logistic(x, y, n)
    # Small shards keep a little more of the smaller class, which the offset makes up for.
    weight = np.log(sizes[1] / sizes[0]) - np.log(kept[1] / kept[0])
    model.offset = offset + float(weight)
    discard(rows)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """Every row as it is, with the probability of good text in the column ``name``.

    A column of that name is replaced.
    """
    docs = docs.drop(name)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(at).to_pylist()]
            arrays = [*batch.columns, pa.array(model.scores(texts), type=pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def verdicts(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Id, whether the row is held out, score and prediction."""
    docs = docs.select("doc_id", "text")
    return score(docs, fit(docs, labels)).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
