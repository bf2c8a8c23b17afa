import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm.divergence import _key, _pair_corrections, _parts, divergence, term_frequencies

SCHEMA = "doc_id long, text string, lang string, source string"


def plain(rows, least, top=50):
    """The contract word by word."""
    docs = []
    for _, text, lang, source in rows:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        docs.append((lang or "", source or "", [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in found]))
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        in_docs = Counter(t for d in own for t in set(d[2]))
        kept = [t for t, n in in_docs.items() if n >= least]

        def shares(terms, kept=kept):
            counts = Counter(terms)
            total = sum(counts[t] for t in kept)
            return counts, {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        _, q = shares([t for d in own for t in d[2]])
        groups = {s: shares([t for d in own if d[1] == s for t in d[2]]) for s in {d[1] for d in own}}
        for s, (counts, p) in groups.items():
            pairs = [(o, sum(abs(p[t] - groups[o][1][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, p[t] - q[t]) for t in kept if counts[t] and p[t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


def corpus(seed, docs=150, sources=6):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "GAMMA", "été", "Été", "naïve", "x", "日本", "𝒳y", "ﬁ", "don't", "a1b", "İ", "ẞ"]
    weights = [rng.random() ** 3 for _ in words]
    rows = []
    for i in range(docs):
        lang = rng.choice(["en", "en", "en", "fr", None, "", "a\0b"])
        source = rng.choice([f"s{rng.randrange(sources)}"] * 8 + [None, "", "ü", "S0"])
        n = rng.choice([0, 1, 5, 40])
        text = rng.choice([None, ""]) if n == 0 else rng.choice([" ", "\n", "-", "_"]).join(rng.choices(words, weights, k=n))
        rows.append((i, text, lang, source))
    rows += [(900, "1234 _ []", "xx", "only"), (901, None, "xx", "other")]
    return rows


def found(frame):
    return sorted(tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize(("seed", "least"), [(1, 3), (2, 8), (3, 1)])
def test_equals_the_plain_version(spark, seed, least):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    # Blocks of little text and chunks of few keys, so that runs are many and get merged.
    assert found(divergence(docs, least, 5, block_text=300, chunk=3)) == plain(rows, least, 5)
    assert found(divergence(docs, least)) == plain(rows, least)


def test_production_parameters_on_repeats_and_a_hot_source(spark):
    rows = [(i, f"common words here w{i % 7} z", "en", "hot" if i % 3 else f"s{i % 5}") for i in range(400)] * 2
    assert found(divergence(spark.createDataFrame(rows, SCHEMA).repartition(3))) == plain(rows, 30)


def test_a_very_long_text_and_a_very_long_term(spark):
    long = " ".join(f"w{'abcdefghij'[i % 10]}" for i in range(400_000)) + " " + "q" * 300_000
    rows = [(1, long, "en", "a"), (2, "wa wb", "en", "b")]
    assert found(divergence(spark.createDataFrame(rows, SCHEMA), 1)) == plain(rows, 1)


def test_empty_table_and_clashing_columns(spark):
    assert divergence(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = corpus(4, 60)
    docs = spark.createDataFrame(rows, SCHEMA)
    more = {c: F.lit(7) for c in ("shard", "first", "keys", "term", "count", "v", "base", "total", "part", "rank", "salt", "p")}
    assert found(divergence(docs.withColumns(more), 2)) == plain(rows, 2)


def test_columns_types_and_counts(spark):
    frame = divergence(spark.createDataFrame(corpus(5, 20), SCHEMA), 1)
    assert dict(frame.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    docs = spark.createDataFrame([(1, "b A a", "en", "x"), (2, "a", "en", "y")], SCHEMA)
    rows = {(r.term, r.count_, tuple(map(tuple, r.sources))) for r in term_frequencies(docs, 1).withColumnRenamed("count", "count_").collect()}
    assert rows == {("a", 3, (("x", 2), ("y", 1))), ("b", 1, (("x", 1),))}


def test_keys_order_like_their_parts():
    langs = [b"", b"a", b"a\0", b"a\0\0", b"a\0b", b"ab", b"b\1", b"\0\1"]
    pairs = [(a, b) for a in langs for b in (b"a", b"ab", b"b")]
    assert [_parts(k) for k in sorted(_key(*t) for t in pairs)] == sorted(pairs)


def test_pairs_of_many_sources_go_out_in_parts(spark, monkeypatch):
    rows = [(i, "one two two" if i % 3 else "one three", "en", f"s{i % 40}") for i in range(160)]
    monkeypatch.setattr("tidemark.llm.divergence.PAIRS_HELD", 50)
    frame = spark.createDataFrame([("en", [f"s{i}" for i in range(40)], [i * i for i in range(40)], [3] * 40)], "l string, s array<string>, p array<long>, b array<long>")
    parts = [r for b in _pair_corrections(iter(frame.toArrow().to_batches())) for r in b.to_pylist()]
    want = {(f"s{i}", f"s{j}"): abs(i * i - j * j) - abs(i * i - 3) - abs(j * j - 3) for i in range(40) for j in range(i + 1, 40)}
    got = Counter()
    for r in parts:
        got[r["a"], r["b"]] += r["value"]
    assert dict(got) == want
    assert found(divergence(spark.createDataFrame(rows, SCHEMA), 1)) == plain(rows, 1)
