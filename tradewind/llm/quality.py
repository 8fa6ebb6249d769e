"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated isotonically.

Random cosines of the standardised statistics approximate a Gaussian kernel. Tasks sum their rows' normal equations, so
the driver solves a system of a fixed size, whatever the number of labelled rows. Raw scores of labelled rows that the
system didn't see are counted in bins, and pooling neighbouring bins that break the order gives rising probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, gives_back, text_batches, written

SYMBOLS = b"#*$%&|<>"
STATISTICS = 15
# Raw scores are near 0 to 1; bins of a thousandth over a wider range.
BINS_LOW, BINS_HIGH, BIN = -1.0, 2.0, 0.001


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    probability: np.ndarray


def statistics(texts: list[str]) -> np.ndarray:
    """A row of statistics per text; all of a text without words are 0."""
    find = re.compile(WORD).findall
    out = np.zeros((len(texts), STATISTICS))
    for row, text in zip(out, texts, strict=True):
        words = find(text)
        if not words:
            continue
        n = len(words)
        kinds = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
        lengths = np.fromiter(map(len, words), np.int64, n)
        chars = int(lengths.sum())
        lines = [x for x in text.split("\n") if x]
        upper, lower = kinds[65:91].sum(), kinds[97:123].sum()
        row[:] = (
            np.log1p(n),
            np.log1p(lengths.mean()),
            np.log1p(lengths.std()),
            (lengths <= 3).mean(),
            len(set(words)) / n,
            sum(map(str.__eq__, words, words[1:])) / n,
            np.log1p(n / max(len(lines), 1)),
            1 - len(set(lines)) / max(len(lines), 1),
            upper / max(upper + lower, 1),
            np.sqrt(sum(kinds[x] for x in SYMBOLS) / chars),
            np.sqrt(kinds[33] / chars),
            np.sqrt(kinds[124] / chars),
            np.sqrt(kinds[48:58].sum() / chars),
            np.sqrt((kinds[46] + kinds[44]) / chars),
            min(kinds[128:].sum() / chars, 1.0),
        )
    return out


def measure(docs: DataFrame) -> DataFrame:
    """Statistics of `docs(doc_id, text)`; a null text counts as empty."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            rows = statistics([t or "" for t in batch.column("text").to_pylist()])
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(list(rows), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "statistics"])

    return docs.select("doc_id", "text").mapInArrow(gives_back(count), "doc_id long, statistics array<double>")


def _features(model: Model, rows: np.ndarray) -> np.ndarray:
    x = np.clip((rows - model.mean) / model.scale, -8, 8)
    return np.hstack([np.cos(x @ model.directions + model.phases), np.ones((len(x), 1))])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), STATISTICS)


def _normal_equations(rows: DataFrame, model: Model) -> np.ndarray:
    """Sum over `rows(statistics, label)` of the products of features, with those of the label as last column."""
    n = len(model.phases) + 1

    def sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, n + 1))
        for batch in batches:
            x = _features(model, _matrix(batch.column("statistics")))
            total += x.T @ np.hstack([x, batch.column("label").to_numpy()[:, None]])
        yield pa.RecordBatch.from_pydict({"row": pa.array(range(n), pa.int32()), "sums": list(total)})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            sums = batch.column("sums").flatten().to_numpy().reshape(len(batch), n + 1)
            for row, own in zip(batch.column("row").to_pylist(), sums, strict=True):
                total[row] = total.get(row, 0) + own
        yield pa.RecordBatch.from_pydict({"row": pa.array(list(total), pa.int32()), "sums": pa.array(list(total.values()), pa.list_(pa.float64()))})

    kinds = "row int, sums array<double>"
    merged = rows.mapInArrow(sum_rows, kinds).repartition("row").mapInArrow(merge, kinds).collect()  # `n` rows
    out = np.zeros((n, n + 1))
    for r in merged:
        out[r["row"]] = r["sums"]
    return out


def isotonic(counts: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Rising means closest to each bin's share of ones, by pooling neighbours that fall."""
    blocks: list[list[float]] = []
    for n, k in zip(counts.tolist(), ones.tolist(), strict=True):
        blocks.append([n, k, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.concatenate([np.full(int(size), k / n) for n, k, size in blocks]) if blocks else np.zeros(0)


def fit(measured: DataFrame, labels: DataFrame, cosines: int = 256, ridge: float = 1e-3, seed: int = 5) -> Model | None:
    """A model of `labels(doc_id, label)` for documents with statistics. All labelled rows count; three quarters of
    them, by a hash of doc_id, enter the normal equations and the others the calibration. None without labelled rows
    in both parts. Labels other than 0 and 1, and those of a null id, teach nothing; a document with several labels, and
    each of several documents of one id, counts once for each."""
    rows = written(measured.join(labels.where("label IN (0, 1) AND doc_id IS NOT NULL"), "doc_id"), "labelled")
    rows = rows.select("statistics", F.col("label").cast("double").alias("label"), (F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(4)) == 0).alias("last"))
    own = rows.where("NOT last")
    columns = [F.col("statistics")[i] for i in range(STATISTICS)]
    found = own.agg(F.count("*"), *(F.avg(c) for c in columns), *(F.stddev_pop(c) for c in columns)).first()
    n = found[0]
    if not n:
        return None
    mean, spread = np.array(found[1 : STATISTICS + 1]), np.array(found[STATISTICS + 1 :])
    random = np.random.default_rng(seed)
    directions = random.normal(size=(STATISTICS, cosines)) / np.sqrt(STATISTICS)
    model = Model(mean, np.where(spread > 1e-9, spread, 1.0), directions, random.uniform(0, 2 * np.pi, cosines), np.zeros(0), np.zeros(0), np.zeros(0))
    sums = _normal_equations(own, model)
    model = model._replace(weights=np.linalg.solve(sums[:, :-1] + ridge * n * np.eye(len(sums)), sums[:, -1]))

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = (raw_scores(model, _matrix(batch.column("statistics"))) - BINS_LOW) / BIN
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), batch.column("label")], names=["bin", "label"])

    counted = rows.where("last").mapInArrow(bins, "bin int, label double").groupBy("bin")
    counts = counted.agg(F.count("*").alias("n"), F.sum("label").alias("ones")).toPandas().sort_values("bin")  # a row per bin
    if not len(counts):
        return None
    shares = isotonic(counts["n"].to_numpy(float), counts["ones"].to_numpy(float))
    return model._replace(raw=BINS_LOW + BIN * (counts["bin"].to_numpy() + 0.5), probability=shares)


def raw_scores(model: Model, rows: np.ndarray) -> np.ndarray:
    return np.clip(_features(model, rows) @ model.weights, BINS_LOW, BINS_HIGH)


def probabilities(model: Model | None, rows: np.ndarray) -> np.ndarray:
    """Of label 1. Without a model 1: nothing is known against a document."""
    return np.ones(len(rows)) if model is None else np.interp(raw_scores(model, rows), model.raw, model.probability)


def score(measured: DataFrame, model: Model | None) -> DataFrame:
    """Per row of statistics: doc_id and score."""
    shared = measured.sparkSession.sparkContext.broadcast(model)  # a fixed size

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = probabilities(shared.value, _matrix(batch.column("statistics")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    return measured.mapInArrow(apply, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model | None, least: float = 0.7) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text scores `least` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            found = probabilities(shared.value, statistics([t or "" for t in batch.column("text").to_pylist()]))
            yield batch.filter(pa.array(found >= least))

    return docs.mapInArrow(gives_back(keep), docs.schema)
