"""Quality classifier: a regularised quadratic discriminant over statistics of a document's text.

Each class has a mean and a covariance, shrunk towards the classes' common
covariance and towards a multiple of the identity. The score is the logistic of
the difference of the classes' log densities, which come from Mahalanobis
distances by the inverse Cholesky factors kept in the model.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    BLOCK_BYTES,
    content,
    fold,
    record_batch,
    slices,
    word_blocks,
    written,
)

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
TO_COMMON, TO_IDENTITY = 0.7, 0.05

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "blank": b" \t\n\r\x0b\x0c",
    "stop": b".,;:'\"()-?",
    "wide": bytes(range(0x80, 0x100)),
}
_CLASS_NAMES = (*_CLASSES, "symbol")


def _class_matrix() -> np.ndarray:
    """Which bytes belong to which class; what belongs to no other is a symbol."""
    matrix = np.zeros((256, len(_CLASS_NAMES)))
    for column, members in enumerate(_CLASSES.values()):
        matrix[list(members), column] = 1
    matrix[:, -1] = 1 - matrix[:, :-1].max(axis=1)
    return matrix


_MATRIX = _class_matrix()
STATISTICS = (
    "log_bytes",
    "log_words",
    "root_symbols",
    "root_upper",
    "root_digits",
    "root_stops",
    "root_wide",
    "root_blanks",
    "log_word_length",
    "log_line_length",
    "vocabulary_growth",
    "distinct_words",
    "distinct_lines",
    "entropy",
)


def statistics(data: bytes) -> list[float]:
    """The transformed statistics of a text in UTF-8: logarithms of sizes, roots of shares, entropy
    of the bytes, and how many words and lines are different."""
    histogram = np.zeros(256, np.int64)
    for start in range(0, len(data), BLOCK_BYTES):
        block = np.frombuffer(data[start : start + BLOCK_BYTES], np.uint8)
        histogram += np.bincount(block, minlength=256)
    size = max(1, len(data))
    upper, lower, digit, blank, stop, wide, symbol = (histogram @ _MATRIX / size).tolist()
    n, vocabulary = 0, set()
    for words in word_blocks(data):
        n += len(words)
        vocabulary.update(words)
    different, lines = len(vocabulary), data.split(b"\n")
    shares = histogram[histogram > 0] / size
    return [
        np.log1p(len(data)),
        np.log1p(n),
        symbol**0.5,
        (upper / max(upper + lower, 1 / size)) ** 0.5,
        digit**0.5,
        stop**0.5,
        wide**0.5,
        blank**0.5,
        np.log1p(size / max(1, n)),
        np.log1p(size / len(lines)),
        np.log1p(different) / np.log1p(max(1, n)),
        (different / max(1, n)) ** 0.5,
        (len(set(lines)) / len(lines)) ** 0.5,
        -float(shares @ np.log2(shares)),
    ]


def document_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per row: id, content (a hash of the text) and x, the statistics of the whole text (null
    as empty)."""
    kind = dict(docs.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            x = [statistics(t or b"") for t in part.column(1).cast(pa.binary()).to_pylist()]
            schema = pa.schema(
                [part.schema.field(0), part.schema.field(2), ("x", pa.list_(pa.float64()))]
            )
            yield record_batch(schema, part.column(0), part.column(2), x)

    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), content(text_column).alias("content")
    )
    return rows.mapInArrow(run, f"id {kind}, content long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """What scoring needs: scale of the statistics, and for each class 0 and 1 the mean, the inverse
    Cholesky factor and the constant of the log density with the class's share."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, ...]
    factors: tuple[np.ndarray, ...]
    constants: tuple[float, ...]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """How likely label 1 is, from 0 to 1."""
        z = (x - self.centre) / self.scale
        logs = [
            constant - 0.5 * (((z - mean) @ factor.T) ** 2).sum(axis=1)
            for mean, factor, constant in zip(self.means, self.factors, self.constants, strict=True)
        ]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(
    counts: np.ndarray,
    sums: np.ndarray,
    squares: np.ndarray,
    to_common: float = TO_COMMON,
    to_identity: float = TO_IDENTITY,
) -> Discriminant | float:
    """The discriminant of classes given by counts, sums of x and sums of x x'.

    With fewer than two rows in a class there is no discriminant: the share of
    label 1 (0.5 without any label) is then the score of every text.
    """
    if counts.min() < 2:
        return float(counts[1] / counts.sum()) if counts.sum() else 0.5
    total = counts.sum()
    centre = sums.sum(axis=0) / total
    spread = np.sqrt(np.maximum(np.diag(squares.sum(axis=0)) / total - centre**2, 0))
    scale = np.where(spread > 1e-9, spread, 1.0)
    means = [(s / n - centre) / scale for s, n in zip(sums, counts, strict=True)]
    covariances = []
    for mean, square, n in zip(means, squares, counts, strict=True):
        raw = mean * scale + centre
        covariances.append((square / n - np.outer(raw, raw)) / np.outer(scale, scale))
    common = sum(c * n for c, n in zip(covariances, counts, strict=True)) / total
    factors, constants = [], []
    for covariance, n in zip(covariances, counts, strict=True):
        mixed = (1 - to_common) * covariance + to_common * common
        level = max(np.trace(mixed) / len(mixed), 1e-6)
        shrunk = (1 - to_identity) * mixed + to_identity * level * np.eye(len(mixed))
        lower = np.linalg.cholesky((shrunk + shrunk.T) / 2)
        factors.append(np.linalg.inv(lower))
        constants.append(float(np.log(n / total) - np.log(np.diag(lower)).sum()))
    return Discriminant(centre, scale, tuple(means), tuple(factors), tuple(constants))


_MOMENTS = pa.schema([("label", pa.int32()), ("place", pa.int32()), ("value", pa.float64())])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count, sum of x and sum of x x' of each label in a task's rows, entry by entry."""
    p = len(STATISTICS)
    table = np.zeros((2, 1 + p + p * p))
    for batch in batches:
        labels = batch.column(0).to_numpy()
        x = batch.column(1).flatten().to_numpy().reshape(-1, p)
        for label in (0, 1):
            own = x[labels == label]
            table[label] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    places = np.arange(table.shape[1])
    for label in (0, 1):
        if table[label, 0]:
            yield record_batch(_MOMENTS, np.full(len(places), label), places, table[label])


def train(
    features: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    label_column: str = "quality",
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
    to_common: float = TO_COMMON,
    to_identity: float = TO_IDENTITY,
) -> Discriminant | float:
    """Fit on every labelled row whose fold is not the one held out.

    Labels other than 0 and 1 count as none. A row repeated in the labels counts
    once, a document with both labels once for each; documents that repeat an id
    each count. Each task sums up its own rows; the driver gets one row for each
    class and entry of the class's moments.
    """
    marked = (
        labels.filter(F.col(label_column).isin(0, 1) & (fold(id_column, folds) != held_out))
        .select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
        .distinct()
    )
    rows = features.join(marked, "id").select("label", "x")
    summed = (
        rows.mapInArrow(_moments, "label int, place int, value double")
        .groupBy("label", "place")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    p = len(STATISTICS)
    table = np.zeros((2, 1 + p + p * p))
    for row in summed:
        table[row["label"], row["place"]] = row["value"]
    return fit(table[:, 0], table[:, 1 : 1 + p], table[:, 1 + p :].reshape(2, p, p), to_common, to_identity)


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> DataFrame:
    """A row per row: id, held_out, score (0 to 1) and predicted (1 if score >= threshold).

    The score depends on the whole text alone; null is scored like an empty text.
    Rows without an id are never held out and never trained on. Rows that repeat an id
    or a text each have their row; one whose id is labelled is trained on as often as it
    is there. Very long texts are measured whole, block by block. An empty table gives
    no rows. Other columns are not read, whatever their names.
    """
    scored = _scored(docs, labels, threshold, folds, held_out, id_column, text_column, label_column)
    return scored.drop("content").withColumnRenamed("id", id_column)


def _scored(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> DataFrame:
    features = written(document_statistics(docs, id_column, text_column), "document-statistics")
    model = train(features, labels, id_column, label_column, folds, held_out)
    kind = dict(docs.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy().reshape(-1, len(STATISTICS))
            scores = np.full(len(x), model) if isinstance(model, float) else model.scores(x)
            schema = pa.schema([batch.schema.field(0), batch.schema.field(1), ("score", pa.float64())])
            yield record_batch(schema, batch.column(0), batch.column(1), scores)

    scored = features.mapInArrow(run, f"id {kind}, content long, score double")
    return scored.select(
        "id",
        "content",
        (F.col("id").isNotNull() & (fold("id", folds) == held_out)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The documents predicted good, with all their columns, each row by its own text.

    The texts are read twice, once to train and once to judge, and are never shuffled.
    Nulls, repeats and long texts count as in ``score_documents``; an empty table stays
    empty, and other columns may have any names.
    """
    model = train(document_statistics(docs, id_column, text_column), labels, id_column)
    text = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            x = np.array([statistics(t or b"") for t in part.column(text).cast(pa.binary()).to_pylist()])
            scores = np.full(len(x), model) if isinstance(model, float) else model.scores(x)
            yield part.filter(pa.array(scores >= threshold))

    return docs.mapInArrow(run, docs.schema)
