import zlib

import duckdb
import numpy as np
import pytest

from tidemark.llm import quality

FOLDER = "/root/testdata/sf0.01"


def fold(i, folds=5):
    return zlib.crc32(str(i).encode()) % folds


def plain_scores(texts, labels, to_common=quality.TO_COMMON, to_identity=quality.TO_IDENTITY):
    """The discriminant by its definition: full covariances, inverses and determinants."""
    x = {i: np.array(quality.statistics((t or "").encode())) for i, t in texts.items()}
    train = [(x[i], label) for i, label in labels.items() if i in x and fold(i) != 0]
    rows = np.array([r for r, _ in train])
    y = np.array([label for _, label in train])
    centre, scale = rows.mean(axis=0), rows.std(axis=0)
    scale[scale < 1e-9] = 1
    z = (rows - centre) / scale
    means = [z[y == k].mean(axis=0) for k in (0, 1)]
    own = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    common = sum(c * (y == k).sum() for k, c in enumerate(own)) / len(y)
    out = {}
    models = []
    for k in (0, 1):
        mixed = (1 - to_common) * own[k] + to_common * common
        shrunk = (1 - to_identity) * mixed + to_identity * np.trace(mixed) / len(mixed) * np.eye(len(mixed))
        models.append((means[k], np.linalg.inv(shrunk), np.linalg.slogdet(shrunk)[1], np.log((y == k).mean())))
    for i, row in x.items():
        a, b = (
            share - 0.5 * logdet - 0.5 * (d := (row - centre) / scale - mean) @ inverse @ d
            for mean, inverse, logdet, share in models
        )
        out[i] = 1 / (1 + np.exp(np.clip(a - b, -700, 700)))
    return out


@pytest.fixture(scope="module")
def tables():
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{FOLDER}/labels.parquet'").fetchall())
    return texts, labels


def test_query_equals_definition_and_finds_quality(spark, tables):
    from tidemark.llm.catalog import op1_quality

    texts, labels = tables
    found = {r.doc_id: r for r in op1_quality(spark, FOLDER).collect()}
    want = plain_scores(texts, labels)
    assert found.keys() == want.keys()
    for i, row in found.items():
        assert row.score == pytest.approx(want[i], abs=1e-6)
        assert row.predicted == int(row.score >= 0.3) and row.held_out == (fold(i) == 0)
    held = [(found[i].predicted, label) for i, label in labels.items() if fold(i) == 0]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95


def test_statistics_of_odd_texts():
    for text in (b"", b" ", b"\n\n\n", b"x", b"!" * 1000, "é漢😀".encode() * 100, b"a " * 500000):
        row = quality.statistics(text)
        assert len(row) == len(quality.STATISTICS) and np.isfinite(row).all()


def test_without_enough_labels_the_share_is_the_score(spark, docs):
    table = docs((1, "a b"), (2, None), (None, ""))
    schema = "doc_id long, quality int"
    empty = quality.score_documents(table, spark.createDataFrame([], schema)).collect()
    assert {r.score for r in empty} == {0.5} and {r.predicted for r in empty} == {1}
    ids = [i for i in (1, 2, 3, 4, 6) if fold(i)][:1]
    one = quality.score_documents(docs(*[(i, "t") for i in ids]), spark.createDataFrame([(i, 1) for i in ids], schema))
    assert {r.score for r in one.collect()} == {1.0}


def test_nulls_repeats_empty_and_columns(spark, tables):
    texts, labels = tables
    rows = [(i, t, 1.5, True) for i, t in texts.items()] + [(None, None, 0.0, False), (None, "", 0.0, False)]
    rows += [r for r in rows if r[0] not in labels][:5]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score double, held_out boolean")
    marks = [(i, q, 1) for i, q in labels.items()] + [(None, 1, 1), (5, None, 1), (6, 7, 1)]
    marks += marks[:20]
    found = quality.score_documents(frame, spark.createDataFrame(marks, "doc_id long, quality int, text int")).collect()
    assert len(found) == len(rows)
    want = plain_scores(texts, labels)
    empty = {r.score for r in found if r.doc_id is None}
    assert len(empty) == 1 and not any(r.held_out for r in found if r.doc_id is None)
    assert all(r.score == pytest.approx(want[r.doc_id], abs=1e-6) for r in found if r.doc_id is not None)
    none = frame.limit(0)
    assert quality.score_documents(none, spark.createDataFrame(marks, "doc_id long, quality int, text int")).count() == 0
    kept = quality.keep_good(frame, spark.createDataFrame(marks, "doc_id long, quality int, text int"))
    assert kept.columns == frame.columns
    good = {r.doc_id for r in found if r.predicted}
    assert {r.doc_id for r in kept.collect()} == good
