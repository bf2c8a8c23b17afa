"""Language identification with error-correcting output codes.

Every language has a codeword. For each bit a binary classifier, naive Bayes
over hashed byte n-grams, tells the languages with a one from those with a
zero; its margin is the mean log odds of the text's n-grams. Decoding takes the
language whose codeword loses least, each bit weighted by how often its
classifier was right on the training texts of that language. The texts where
two codewords lose nearly alike are flagged.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, record_batch, slices, written

FOLDS, HELD_OUT = 4, 2
DIMENSIONS = 1 << 13
ORDERS = (1, 2, 3)
SHARPNESS = 3.0
AMBIGUOUS = 0.1
BLOCK = 1 << 20
UNKNOWN = "und"
SEED = 11

# Bytes that aren't letters of ASCII or parts of other characters count as a blank.
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0x80 else 32 for b in range(256))


def ngram_counts(text: str) -> np.ndarray:
    """Counts of the text's hashed byte n-grams of every order, letters in lower case.

    Long texts are counted in blocks; an n-gram across two blocks counts too.
    """
    counts = np.zeros(DIMENSIONS, np.int64)
    lower = text if text.isascii() else text.lower()
    data = b" " + lower.encode().translate(_FOLDED) + b" "
    for start in range(0, len(data), BLOCK):
        block = np.frombuffer(data[start : start + BLOCK + max(ORDERS) - 1], np.uint8).astype(np.uint32)
        own = min(BLOCK, len(data) - start)
        gram = np.zeros(len(block), np.uint32)
        for order in range(1, max(ORDERS) + 1):
            gram = (gram[: len(block) - order + 1] << 8) | block[order - 1 :]
            if order in ORDERS:
                hashed = (gram[:own] * np.uint32(2654435761) + np.uint32(order * 0x9E3779B9 & 0xFFFFFFFF)) >> 19
                counts += np.bincount(hashed, minlength=DIMENSIONS)
    return counts


def codewords(languages: int) -> np.ndarray:
    """A row of bits for each language.

    Up to six languages: every way to part them in two, 2^(n-1) - 1 bits. More:
    random words of ceil(10 log2 n) bits, the best of 200 draws by the least
    distance between two rows, no bit alike for all languages.
    """
    if languages < 2:
        return np.zeros((languages, 0), np.int64)
    if languages <= 6:
        columns = np.arange(1, 1 << (languages - 1))
        return columns[None, :] >> np.arange(languages)[:, None] & 1
    rng = np.random.default_rng(SEED)
    width, best, least = int(np.ceil(10 * np.log2(languages))), None, -1
    for _ in range(200):
        draw = rng.integers(0, 2, (languages, width))
        if (draw.min(axis=0) == draw.max(axis=0)).any():
            continue
        apart = (draw[:, None, :] != draw[None, :, :]).sum(axis=2) + np.eye(languages, dtype=int) * width
        if apart.min() > least:
            best, least = draw, int(apart.min())
    return best


@dataclass(frozen=True)
class Codes:
    """Languages, their codewords, the log odds of every n-gram for each bit, and the weight of each
    bit for each language (rows sum to one)."""

    languages: tuple[str, ...]
    words: np.ndarray
    odds: np.ndarray
    weights: np.ndarray

    def margins(self, counts: np.ndarray) -> np.ndarray:
        return counts @ self.odds / max(1, counts.sum())

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, score and whether it is ambiguous, for rows of margins."""
        signs = 2 * self.words - 1
        loss = np.logaddexp(0, -SHARPNESS * margins[:, None, :] * signs[None, :, :])
        total = (loss * self.weights[None, :, :]).sum(axis=2)
        p = np.exp(-(total - total.min(axis=1, keepdims=True)) * max(1, self.words.shape[1]))
        p /= p.sum(axis=1, keepdims=True)
        ranked = np.sort(p, axis=1)
        second = ranked[:, -2] if p.shape[1] > 1 else np.zeros(len(p))
        return p.argmax(axis=1), ranked[:, -1], ranked[:, -1] - second < AMBIGUOUS


def _has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def _trained_on(docs: DataFrame, folds: int, held_out: int, id_column: str, lang_column: str) -> DataFrame:
    return docs.filter(F.col(lang_column).isNotNull() & (fold(id_column, folds) != held_out))


def gram_sums(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """Counts of each hashed n-gram in all texts of each language: lang, place, n.

    Each task sums its own texts first, so a task hands on at most one row for
    each language and n-gram of a batch, whatever one language's share is.
    """
    schema = pa.schema([("lang", pa.string()), ("place", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part in slices(batches, 1):
            for lang, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if text:
                    sums[lang] = sums.get(lang, 0) + ngram_counts(text)
                elif lang not in sums:
                    sums[lang] = np.zeros(DIMENSIONS, np.int64)
        for lang, counts in sums.items():
            places = np.flatnonzero(counts) if counts.any() else np.zeros(1, np.int64)
            yield record_batch(schema, [lang] * len(places), places, counts[places])

    rows = docs.select(F.col(lang_column).cast("string"), F.col(text_column))
    return (
        rows.mapInArrow(run, "lang string, place int, n long")
        .groupBy("lang", "place")
        .agg(F.sum("n").alias("n"))
    )


def fit_bits(sums: DataFrame) -> Codes:
    """Naive Bayes for each bit from the languages' n-gram counts; every weight alike as yet.

    The driver gets a row for each language and hashed n-gram, at most
    ``DIMENSIONS`` for each language.
    """
    rows = sums.collect()
    languages = tuple(sorted({r["lang"] for r in rows}))
    place = {lang: i for i, lang in enumerate(languages)}
    counts = np.zeros((len(languages), DIMENSIONS))
    for row in rows:
        counts[place[row["lang"]], row["place"]] = row["n"]
    share = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
    words = codewords(len(languages))
    floor = 0.1 / DIMENSIONS
    odds = np.zeros((DIMENSIONS, words.shape[1]))
    for bit in range(words.shape[1]):
        ones = share[words[:, bit] == 1].mean(axis=0)
        zeros = share[words[:, bit] == 0].mean(axis=0)
        odds[:, bit] = np.log(ones + floor) - np.log(zeros + floor)
    weights = np.full(words.shape, 1 / max(1, words.shape[1]))
    return Codes(languages, words, odds, weights)


def bit_margins(
    docs: DataFrame, codes: Codes, id_column: str, text_column: str, lang_column: str, folds: int, held_out: int
) -> DataFrame:
    """Written table, a row per row: id, lettered, m (margins), and lang where the row is trained on."""
    shared = docs.sparkSession.sparkContext.broadcast(codes)
    kind = dict(docs.dtypes)[id_column]
    trained = F.when(fold(id_column, folds) != held_out, F.col(lang_column).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in slices(batches, 1):
            texts = part.column(1).to_pylist()
            lettered = [_has_letter(t) for t in texts]
            margins = [
                model.margins(ngram_counts(t)) if ok else np.zeros(model.odds.shape[1])
                for t, ok in zip(texts, lettered, strict=True)
            ]
            schema = pa.schema(
                [
                    part.schema.field(0),
                    ("lettered", pa.bool_()),
                    ("m", pa.list_(pa.float64())),
                    ("lang", pa.string()),
                ]
            )
            yield record_batch(schema, part.column(0), lettered, margins, part.column(2))

    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), trained.alias("lang")
    )
    return written(
        rows.mapInArrow(run, f"id {kind}, lettered boolean, m array<double>, lang string"), "language-margins"
    )


def weigh_bits(codes: Codes, margins: DataFrame) -> Codes:
    """The codes with each bit weighted by the share of a language's training texts it gets right."""
    if not codes.words.shape[1]:
        return codes
    right = np.full(codes.words.shape, 0.5)
    ones = [F.avg((F.col("m")[b] > 0).cast("double")).alias(f"b{b}") for b in range(codes.words.shape[1])]
    rows = margins.filter("lang IS NOT NULL AND lettered").groupBy("lang").agg(*ones).collect()
    place = {lang: i for i, lang in enumerate(codes.languages)}
    for row in rows:
        i, share = place[row["lang"]], np.array(row[1:])
        right[i] = np.where(codes.words[i] == 1, share, 1 - share)
    weights = np.maximum(right, 1e-3)
    return Codes(codes.languages, codes.words, codes.odds, weights / weights.sum(axis=1, keepdims=True))


def identify(
    docs: DataFrame,
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """A row per row: id, held_out, lang_pred, score (0 to 1) and ambiguous.

    Learns from the rows with a language whose fold is not the one held out, all
    of them; a prediction depends on the whole text alone. A text that is null
    or has no letter is ``und`` with score 0. With one language to learn from
    every other text is predicted that with score 1, with none ``und``. A row
    without an id is never held out. Rows that repeat an id or a text each have their
    row, and each counts in training. Of languages that lose alike the first by name
    is taken. Very long texts are counted block by block, whole. An empty table gives
    no rows. Other columns are not read.
    """
    codes = fit_bits(gram_sums(_trained_on(docs, folds, held_out, id_column, lang_column), lang_column, text_column))
    margins = bit_margins(docs, codes, id_column, text_column, lang_column, folds, held_out)
    shared = docs.sparkSession.sparkContext.broadcast(weigh_bits(codes, margins))
    kind = dict(docs.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        schema = None
        for batch in batches:
            n, bits = batch.num_rows, model.words.shape[1]
            lettered = batch.column(1).to_numpy(zero_copy_only=False)
            names, scores, unsure = np.array([UNKNOWN] * n, object), np.zeros(n), np.zeros(n, bool)
            if model.languages and n:
                m = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, bits)
                which, p, close = model.decode(m)
                names[lettered] = np.array(model.languages, object)[which[lettered]]
                scores[lettered], unsure[lettered] = p[lettered], close[lettered]
            schema = pa.schema(
                [
                    batch.schema.field(0),
                    ("lang_pred", pa.string()),
                    ("score", pa.float64()),
                    ("ambiguous", pa.bool_()),
                ]
            )
            yield record_batch(schema, batch.column(0), names, scores, unsure)

    decoded = margins.select("id", "lettered", "m").mapInArrow(
        run, f"id {kind}, lang_pred string, score double, ambiguous boolean"
    )
    return decoded.select(
        F.col("id").alias(id_column),
        (F.col("id").isNotNull() & (fold("id", folds) == held_out)).alias("held_out"),
        "lang_pred",
        "score",
        "ambiguous",
    )
