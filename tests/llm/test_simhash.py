import random

import brute
import duckdb
import numpy as np
import pytest

from tidemark.llm import simhash
from tidemark.llm.components import component_roots
from tidemark.llm.golay import nearby_codewords


def flipped(values, bits, width, rng):
    out = values.copy()
    for i in range(len(out)):
        for b in rng.choice(width, bits, replace=False):
            out[i] ^= out.dtype.type(1 << int(b))
    return out


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_nearby_codewords_meet_within_two_bits(bits):
    rng = np.random.default_rng(bits)
    words = rng.integers(0, 1 << 23, 5000)
    pairs = zip(nearby_codewords(words), nearby_codewords(flipped(words, bits, 23, rng)), strict=True)
    assert all(set(a) & set(b) for a, b in pairs)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_fingerprints_within_three_bits_share_a_key(bits):
    rng = np.random.default_rng(bits)
    values = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
    sets = []
    for side in (values, flipped(values, bits, 64, rng)):
        keys, owners = simhash.golay_keys(side)
        own = [set() for _ in values]
        for key, owner in zip(keys.tolist(), owners.tolist(), strict=True):
            own[owner].add(key)
        sets.append(own)
    assert all(a & b for a, b in zip(*sets, strict=True))


@pytest.mark.parametrize(
    "text",
    [None, "", " \t\n\x0b\x0c\r", "One", "One two", "a b c", "A\xa0b c　d É é", "x y z " * 300, "\x1c a\x1cb\x85 c d"],
)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute.fingerprint(text)
    assert simhash.fingerprint(text, block=7) == brute.fingerprint(text)


def test_stars_join_what_is_near():
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 64, 20, dtype=np.uint64)
    values = np.unique(np.concatenate([flipped(centres, n, 64, rng) for n in (0, 1, 2, 3, 5)]))
    members, least = simhash.stars(values)
    found = {int(x): int(x) for x in values} | dict(zip(members, least, strict=True))
    want = brute.components([(int(x), int(x)) for x in values])
    assert [found[int(x)] for x in values] == want
    assert len(members) == len(values) - len(set(want))


@pytest.mark.parametrize("block_rows", [4, 1 << 14])
def test_components_of_crowded_fingerprints(spark, block_rows):
    rng = np.random.default_rng(block_rows)
    centres = rng.integers(0, 1 << 64, 6, dtype=np.uint64)
    values = np.concatenate([centres, *(flipped(np.repeat(centres, 8), n, 64, rng) for n in (1, 2, 3, 4, 6))])
    rows = [(i, int(v)) for i, v in enumerate(values)]
    frame = spark.createDataFrame([(i, int(np.uint64(v).view(np.int64))) for i, v in rows], "id long, fp long")
    found = simhash._labelled(frame, 3, block_rows).collect()
    assert sorted((r.id, r.component_id) for r in found) == list(zip(range(len(rows)), brute.components(rows), strict=True))


def test_long_chain(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1001), (7, 7)]
    random.Random(1).shuffle(links)
    found = {r.u: r.root for r in component_roots(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {1001: 1000}


@pytest.mark.parametrize(("most", "tasks"), [(3, 7), (50, 5), (1000, 1), (1000, 6)])
def test_components_of_any_number_of_forests(spark, most, tasks):
    rng = random.Random(most)
    nodes = [rng.randrange(-(2**62), 2**62) for _ in range(150)]
    links = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(120)] + [(nodes[0], n) for n in nodes[1:30]]
    label = {n: n for n in nodes}
    for _ in range(len(nodes)):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    frame = spark.createDataFrame(links, "u long, v long").repartition(tasks)
    found = {r.u: r.root for r in component_roots(frame, most).collect()}
    assert found == {n: r for n, r in label.items() if n != r}


def test_groups_nulls_repeats_and_columns(spark):
    rows = [(5, "Some Words here now"), (3, "some words\there now"), (3, "some words\there now"), (9, None)]
    rows += [(8, ""), (None, "alone in this"), (None, " "), (2, "w " * 30000), (1, "w " * 29999)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fp int, component_id string")
    found = sorted((tuple(r) for r in simhash.near_groups(frame).collect()), key=repr)
    prints = [(i, brute.fingerprint(t)) for i, t in rows]
    labels = brute.components(prints)
    assert found == sorted(((i, f"{p:016x}", c) for (i, p), c in zip(prints, labels, strict=True)), key=repr)
    kept = sorted((r.doc_id for r in simhash.drop_near(frame).collect()), key=repr)
    assert kept == sorted((i for (i, _), c in zip(prints, labels, strict=True) if i == c), key=repr)
    assert simhash.drop_near(frame).columns == frame.columns


def test_one_row_of_each_component_stays(spark):
    long = "w " * 3000
    near = [f"{long}{end}" for end in ("one", "two", "three", "four")]
    prints = [brute.fingerprint(t) for t in near]
    assert all((a ^ b).bit_count() <= 3 for a in prints for b in prints)
    rows = [(None, t) for t in near for _ in range(3)] + [(4, "ab cd ef gh"), (4, "AB cd ef gh"), (6, "ab cd EF gh")]
    rows += [(None, "ab cd ef GH"), (None, None), (None, ""), (None, " "), (7, "of its own, far from others")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, content string")
    kept = simhash.drop_near(frame, repeats=False)
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert len(found) == 4 and kept.columns == frame.columns
    groups = [{(None, t) for t in near}, {(None, None), (None, ""), (None, " ")}]
    groups += [{(4, "ab cd ef gh"), (4, "AB cd ef gh")}, {(7, "of its own, far from others")}]
    assert all(len(group & set(found)) == 1 for group in groups)
    again = simhash.drop_near(frame.repartition(5), repeats=False).collect()
    assert [brute.fingerprint(r.text) for r in sorted(again, key=repr)] == [
        brute.fingerprint(r.text) for r in sorted(kept.collect(), key=repr)
    ]
    assert simhash.drop_near(frame).filter("text LIKE 'w %'").count() == 3


def test_empty_table(docs):
    assert simhash.near_groups(docs()).count() == 0
    assert simhash.drop_near(docs()).count() == 0


def test_query_over_documents(spark):
    from tidemark.llm.catalog import op6_simhash

    folder = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()
    prints = [(i, brute.fingerprint(t)) for i, t in rows]
    want = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, brute.components(prints), strict=True)]
    assert sorted(tuple(r) for r in op6_simhash(spark, folder).collect()) == want
