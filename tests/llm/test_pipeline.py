import brute
import corpus_pipeline
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_packing import check
from test_quality import plain_scores

from tidemark.llm import packing
from tidemark.session import new_folder

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_run(rows, labels):
    """What is left of (doc_id, text) before packing, by the plainest means."""
    scores = plain_scores(dict(rows), labels)
    good = [(i, t) for i, t in rows if scores[i] >= 0.3]
    first = {}
    for i, t in sorted(good):
        first.setdefault(t or "", i)
    single = [(i, t) for i, t in good if first[t or ""] == i]
    prints = [(i, brute.fingerprint(t)) for i, t in single]
    stay = {i for (i, _), c in zip(prints, brute.components(prints), strict=True) if i == c}
    return {i: brute.redacted(t, brute.secrets(t)) for i, t in single if i in stay}


@pytest.fixture(scope="module")
def run_stages(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        path = new_folder(spark, "pipeline-test")
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_equal_plain_run(run_stages):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{FOLDER}/labels.parquet'").fetchall())
    want = plain_run(rows, labels)
    assert 0 < len(want) < len(rows)
    found = {r.doc_id: r for r in run_stages[3].collect()}
    assert {i: r.text for i, r in found.items()} == want
    sizes = {i: len((t or "").encode()) + 1 for i, t in want.items()}
    total = check(run_stages[4].collect(), sizes, packing.LENGTHS)
    assert sum(sizes.values()) <= total


def test_stages_return_documents(run_stages):
    for docs in run_stages[:-1]:
        assert docs.columns == COLUMNS
    changed = run_stages[3].filter(F.length("text") != F.col("n_chars"))
    assert changed.join(run_stages[2], ["doc_id", "text"]).count() == changed.count()


def test_run_equals_stages(spark, run_stages):
    found = sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect()))
    assert found == sorted(map(tuple, run_stages[-1].collect()))


def test_odd_documents(spark):
    labels = new_folder(spark, "odd")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{labels}/labels.parquet")
    rows = [(1, None, None, None, None, "k"), (1, None, None, None, None, "k"), (2, "", "en", "s", 0, None)]
    rows += [(3, "w " * 60000, "en", "s", 120000, None), (None, "secret=abcdefghij", None, None, 17, "k")]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score string"
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, labels)
        assert docs.columns == [*COLUMNS, "score"]
    found = sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert found == [(1, None), (3, "w " * 60000), (None, "[assign]")]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, labels).count() == 0


def test_near_copies_without_an_id_or_with_one_id(spark):
    texts = [f"{'w ' * 3000}{end}" for end in ("one", "two", "three")]
    others = ["ab cd ef gh", "AB cd ef gh", "ab cd EF gh"]
    rows = [(None, t, "k") for t in texts] + [(5, t, "k") for t in others]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    single = corpus_pipeline.exact_copies(spark, docs, FOLDER)
    assert single.count() == 6
    left = corpus_pipeline.near_copies(spark, single, FOLDER).collect()
    assert sorted((r.doc_id or 0, r.text in texts) for r in left) == [(0, True), (5, False)]
    again = corpus_pipeline.near_copies(spark, docs.unionByName(docs), FOLDER).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, left))


def test_scores_are_not_all_alike(run_stages, spark):
    before = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    counts = [before, *(d.count() for d in run_stages[:4])]
    assert np.all(np.diff(counts) <= 0) and counts[1] < before and counts[3] == counts[4]
