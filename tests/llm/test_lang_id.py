import math
import zlib
from collections import Counter
from functools import cache

import duckdb
import numpy as np
import pytest

from tidemark.llm import lang_id


def fold(i):
    return zlib.crc32(str(i).encode()) % 4


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 7, 12, 40])
def test_codewords_differ(n):
    words = lang_id.codewords(n)
    apart = (words[:, None, :] != words[None, :, :]).sum(axis=2) + np.eye(n, dtype=int) * 1000
    assert apart.min() >= (1 if n == 2 else 2 ** (n - 2) if n <= 6 else words.shape[1] // 5)
    assert ((words.min(axis=0) == 0) & (words.max(axis=0) == 1)).all()


def test_counts_do_not_depend_on_blocks(monkeypatch):
    text = "Größe ist RELATIV; " * 50
    whole = lang_id.ngram_counts(text)
    monkeypatch.setattr(lang_id, "BLOCK", 64)
    assert (lang_id.ngram_counts(text) == whole).all()
    size = len(text.encode()) + 2
    assert whole.sum() == 3 * size - 3


def test_query_on_held_out_documents(spark):
    from tidemark.llm.catalog import op9_language

    folder = "/root/testdata/sf0.01"
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{folder}/documents.parquet'").fetchall())
    found = op9_language(spark, folder).collect()
    assert {r.doc_id for r in found} == truth.keys()
    assert all(r.held_out == (fold(r.doc_id) == 2) and 0 <= r.score <= 1 for r in found)
    held = [r.lang_pred == truth[r.doc_id] for r in found if r.held_out]
    assert len(held) > 150 and np.mean(held) > 0.95


def plain(rows):
    """Language, score and ambiguity by the same method, one n-gram and one bit at a time."""

    @cache
    def grams(text):
        data = [ord(" ")] + [b if 97 <= b <= 122 or b >= 0x80 else ord(" ") for b in text.lower().encode()] + [ord(" ")]
        counts = Counter()
        for order in (1, 2, 3):
            for i in range(len(data) - order + 1):
                number = int.from_bytes(bytes(data[i : i + order]), "big")
                counts[(number * 2654435761 + order * 0x9E3779B9) % 2**32 // 2**19] += 1
        return counts

    trained = [(text, lang) for i, text, lang in rows if lang is not None and fold(i) != 2]
    langs = sorted({lang for _, lang in trained})
    totals = {lang: Counter() for lang in langs}
    for text, lang in trained:
        totals[lang].update(grams(text) if text else {})
    share = {lang: {g: n / counts.total() for g, n in counts.items()} for lang, counts in totals.items()}
    bits = range(1, 2 ** (len(langs) - 1))
    word = {lang: [bit >> place & 1 for bit in bits] for place, lang in enumerate(langs)}

    @cache
    def odds(gram, b):
        sides = [[share[lang].get(gram, 0) for lang in langs if word[lang][b] == side] for side in (1, 0)]
        one, zero = (sum(side) / len(side) + 0.1 / 8192 for side in sides)
        return math.log(one) - math.log(zero)

    @cache
    def margins(text):
        counts = grams(text)
        return [sum(n * odds(g, b) for g, n in counts.items()) / counts.total() for b in range(len(bits))]

    def lettered(text):
        return text is not None and any(map(str.isalpha, text))

    weight = {}
    for lang in langs:
        own = [margins(text) for text, its in trained if its == lang and lettered(text)]
        right = [sum((m[b] > 0) == word[lang][b] for m in own) / len(own) for b in range(len(bits))]
        right = [max(r, 0.001) for r in right]
        weight[lang] = [r / sum(right) for r in right]
    out = {}
    for i, text, _ in rows:
        if not lettered(text):
            out[i] = ("und", 0.0, None)
            continue
        loss = {
            lang: sum(
                w * math.log1p(math.exp(-3 * m * (1 if bit else -1)))
                for w, m, bit in zip(weight[lang], margins(text), word[lang], strict=True)
            )
            for lang in langs
        }
        p = {lang: math.exp(-len(bits) * (x - min(loss.values()))) for lang, x in loss.items()}
        first, second = sorted((x / sum(p.values()) for x in p.values()), reverse=True)[:2]
        out[i] = (max(p, key=p.get), first, first - second < 0.1)
    return out


def test_query_equals_plain_version(spark):
    from tidemark.llm.catalog import op9_language

    folder = "/root/testdata/sf0.001"
    want = plain(duckdb.sql(f"SELECT doc_id, text, lang FROM '{folder}/documents.parquet'").fetchall())
    rows = op9_language(spark, folder).collect()
    assert len(rows) == len(want) and len({r.lang_pred for r in rows}) > 2
    for r in rows:
        lang, score, ambiguous = want[r.doc_id]
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-9)
        assert lang == "und" or r.ambiguous == ambiguous


SCHEMA = "doc_id long, text string, lang string"


def english_and_german(n=40):
    rows = []
    for i in range(n):
        rows.append((i, "the thing that was there with them and other words " * 3, "en"))
        rows.append((1000 + i, "der die das und nicht mit einer schönen Straße dort " * 3, "de"))
    return rows


def test_two_languages_and_undetermined(spark):
    rows = english_and_german()
    odd = [(5000, None, "en"), (5001, "", None), (5002, "12 34 !!", None), (5003, "the other thing", None)]
    odd += [(5004, "Straße und das", None), (None, "the words", "de"), (5005, "漢字", None)]
    odd += [(5006, "THE THING THAT " * 100000, None)]
    found = lang_id.identify(spark.createDataFrame(rows + odd, SCHEMA)).collect()
    pred = {r.doc_id: r for r in found}
    assert [pred[i].lang_pred for i in range(5000, 5005)] == ["und", "und", "und", "en", "de"]
    assert [pred[i].score for i in (5000, 5001, 5002)] == [0, 0, 0]
    assert pred[5005].lang_pred in ("en", "de") and pred[5006].lang_pred == "en"
    assert not pred[None].held_out
    assert all(pred[i].lang_pred == lang for i, _, lang in rows)


def test_ambiguity_is_flagged(spark):
    rows = english_and_german()
    half = "the thing that was there der die das und nicht "
    codes = lang_id.fit_bits(lang_id.gram_sums(spark.createDataFrame(rows, SCHEMA)))
    sure = codes.decode(np.array([codes.margins(lang_id.ngram_counts(rows[0][1]))]))
    unsure = codes.decode(np.zeros((1, 1)))
    assert not sure[2][0] and unsure[2][0] and unsure[1][0] == pytest.approx(0.5)
    mixed = codes.decode(np.array([codes.margins(lang_id.ngram_counts(half))]))
    assert mixed[1][0] < sure[1][0]


def test_one_language_none_and_empty(spark):
    one = [(i, "some words", "en") for i in range(8)]
    found = lang_id.identify(spark.createDataFrame(one, SCHEMA)).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("en", 1.0)}
    found = lang_id.identify(spark.createDataFrame([(1, "some words", None)], SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)]
    assert lang_id.identify(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeats_and_clashing_columns(spark):
    rows = [(*r, 1, "x") for r in english_and_german()]
    rows += rows[:3]
    frame = spark.createDataFrame(rows, SCHEMA + ", score int, lang_pred string")
    found = lang_id.identify(frame)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score", "ambiguous"]
    assert found.count() == len(rows)
