import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm.jaccard_join import (
    SKETCH_MOST,
    _neighbours,
    _odd_apart,
    _odd_bits,
    _parities,
    _Shingles,
    _sketched,
    _to_prefixes,
    _within_keys,
    prefix_length,
    similar_groups,
)


def shingles(text, words=5):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)} or ({tuple(found)} if found else set())


def plain(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and common and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                label[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    out = [(i, len(s), least.get(root(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))]
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def varied(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(["x", "y", "Z"]) + str(rng.randrange(9))
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choices(vocabulary, k=30))
    rows = []
    for _ in range(25):
        base = " ".join(rng.choices(vocabulary, k=rng.choice([3, 5, 6, 9, 40, 120])))
        if rng.random() < 0.4:
            base += " " + passage
        # From copies to a few more edits than a link allows, and edits of edits.
        for _ in range(rng.randrange(1, 9)):
            rows.append(base)
            base = varied(base, rng, rng.randrange(4)) if rng.random() < 0.7 else base
    rows += [None, "", " \n", "one", "One", "two words", "a b c d e", "a b c d e a b c d e"]
    rng.shuffle(rows)
    return list(enumerate(rows, 1))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_pairs(spark, docs, seed):
    rows = corpus(seed)
    assert found(similar_groups(docs(*rows).repartition(3), counters_log2=8, block_rows=3)) == plain(rows)
    assert found(similar_groups(docs(*rows), orders=3)) == plain(rows)


def test_pairs_not_found_by_neighbours_are_found_by_prefixes(spark, docs):
    """With no leading tokens and no minima nothing is linked beforehand."""
    rows = corpus(4)
    assert found(similar_groups(docs(*rows), leading=0, minima=0, rounds=1, block_rows=2)) == plain(rows)


def test_a_large_group_of_near_copies_and_a_common_passage(spark, docs):
    rng = random.Random(5)
    base = " ".join(f"w{rng.randrange(500)}" for _ in range(80))
    rows = [(i, varied(base, rng, 1)) for i in range(300)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(1000 + i, passage + " " + " ".join(f"u{i}-{j}" for j in range(rng.choice([2, 8, 30])))) for i in range(100)]
    rows += [(2000 + i, base.upper()) for i in range(200)]
    assert found(similar_groups(docs(*rows).repartition(4), block_rows=64)) == plain(rows)


def test_ids_nulls_repeats_and_clashing_columns(spark, docs):
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (None, "q r s"), (5, "q r  S"), (None, "n"), (3, None), (3, "")]
    frame = docs(*rows).withColumns({c: F.lit(1) for c in ("n", "lo", "hi", "ref", "root", "id", "key", "a", "b")})
    assert found(similar_groups(frame)) == plain(rows)


def test_empty_table(spark, docs):
    assert similar_groups(docs()).collect() == []
    assert found(similar_groups(docs((1, None), (2, " ")))) == [(1, 0, 1), (2, 0, 2)]


def test_a_very_long_text(spark, docs):
    rng = random.Random(6)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(200_000))
    rows = [(3, long), (2, varied(long, rng, 3000)), (1, long[: len(long) // 2]), (4, "x" * 3_000_000)]
    assert found(similar_groups(docs(*rows))) == plain(rows)


def test_blocks_of_a_text_make_no_difference():
    rng = random.Random(7)
    for n in (0, 1, 4, 5, 6, 300):
        text = " ".join(rng.choice("abc") * rng.randrange(1, 4) for _ in range(n)).encode()
        whole = _Shingles(5).of(text)
        assert len(whole) == len(shingles(text.decode()))
        assert all(np.array_equal(_Shingles(5, block).of(text), whole) for block in (1, 7, 40))


def test_neighbours_and_heads_however_rows_come():
    rng = np.random.default_rng(8)
    key = np.sort(rng.integers(0, 9, 60))
    columns = [key, np.arange(60), rng.integers(8, 12, 60), rng.integers(0, 2, 60), rng.integers(0, 30, 60)]
    whole = pa.record_batch(columns, names=["key", "ref", "n", "sketch", "root"])
    expected, head = set(), 0
    for i in range(1, 60):
        head = head if key[i] == key[head] else i
        for j in {i - 1, head} - {i}:
            n, m = sorted(int(columns[2][x]) for x in (i, j))
            if key[i] == key[j] and columns[4][i] != columns[4][j] and 100 * n >= 80 * m:
                expected.add((j, i))
    for size in (1, 2, 7, 60):
        batches = [whole.slice(at, size) for at in range(0, 60, size)] + [whole.slice(0, 0)]
        pairs = [b for b in _neighbours(80)(iter(batches))]
        assert {(r["a"], r["b"]) for b in pairs for r in b.to_pylist()} == expected


def test_a_sketch_agrees_as_sets_do():
    rng = np.random.default_rng(9)
    tokens = np.unique(rng.integers(0, 2**63, 1200).astype(np.uint64) * np.uint64(2))
    one, other = (np.sort(rng.permutation(tokens)[:1100]) for _ in range(2))
    (a, keys), (b, others) = (_sketched(s, 16) for s in (one, other))
    similarity = len(np.intersect1d(one, other)) / len(np.union1d(one, other))
    differing = int(np.bitwise_count((a ^ b).view(np.uint64))[0])
    assert similarity > 0.8 and differing <= SKETCH_MOST and len(np.intersect1d(keys, others)) > 8
    assert _sketched(tokens[:1], 4)[1].shape == (4,)


@pytest.mark.parametrize("n", [1, 7, 150, 3000])
def test_sets_differ_by_at_least_their_parities(n):
    rng = np.random.default_rng(n)
    for changed in {0, 1, n // 9, n // 4, n}:
        one = rng.integers(0, 2**64, n, np.uint64)
        other = np.concatenate([one[changed:], rng.integers(0, 2**64, changed + changed // 3, np.uint64)])
        apart = np.bitwise_count((_parities(one) ^ _parities(other)).view(np.uint64)).sum()
        assert apart <= len(np.setxor1d(one, other)) and (changed or not apart)
        # Such a set of few tokens is told apart by nearly all that differ.
        assert n > 150 or changed > n // 4 or apart >= 0.6 * len(np.setxor1d(one, other)) - 1


def formed(sets, task_of):
    """How often each pair of the sets, each of its own component, is formed when keys are dealt to tasks."""
    lists = pa.array([s.view(np.int64).tolist() for s in sets], pa.list_(pa.int64()))
    refs = pa.array(range(len(sets)), pa.int64())
    batch = pa.record_batch([refs, refs, lists], names=["ref", "root", "shingles"])
    rarity = SimpleNamespace(value=np.zeros(1 << 8, np.uint8))
    rows = pa.Table.from_batches(_to_prefixes(rarity, 8, 80)(iter([batch]))).sort_by("key")
    tasks, out = np.array([task_of(key) for key in rows["key"].to_pylist()]), Counter()
    for task in np.unique(tasks):
        own = rows.filter(pa.array(tasks == task)).combine_chunks()
        for found in _within_keys(80, 1 << 10)(iter(own.to_batches())):
            out.update((r["a"], r["b"]) for r in found.to_pylist() if r["a"] is not None)
    return out


def changed_sets(seed, size, count, changed):
    rng = np.random.default_rng(seed)
    base, sets = rng.integers(0, 2**64, size, np.uint64), []
    for _ in range(count):
        kept = rng.permutation(base)[: size - changed]
        sets.append(np.unique(np.concatenate([kept, rng.integers(0, 2**64, changed, np.uint64)])))
    return sets


@pytest.mark.parametrize("size, changed", [(1500, 170), (300, 28), (300, 20)])
def test_a_pair_is_formed_a_few_times_in_however_many_tasks(size, changed):
    """Sets that are alike share most of their prefix tokens; were a pair formed in each task that
    holds one, its rows would be nearly as many as those."""
    sets = changed_sets(11, size, 12, changed)
    pairs = [(i, j) for j in range(12) for i in range(j)]
    for tasks in (1, 2**62):
        times = formed(sets, lambda key, tasks=tasks: key % tasks)
        linked = {(i, j) for i, j in pairs if len(np.intersect1d(sets[i], sets[j])) * 180 >= 80 * (len(sets[i]) + len(sets[j]))}
        assert linked <= set(times)
        assert sum(times.values()) <= (1 + prefix_length(size, 80) // 20) * len(pairs)


@pytest.mark.parametrize("n", [1, 2, 5, 9, 40, 700])
def test_every_link_is_formed_at_the_limit_of_similarity(n):
    """Sets of sizes n and m with just the overlap that it takes, also one within the other."""
    rng = np.random.default_rng(n)
    for m in {n, n + n // 8, n + n // 4}:
        for _ in range(20):
            common = -(-80 * (n + m) // 180)
            tokens = rng.integers(0, 2**64, n + m - common, np.uint64)
            one, other = np.unique(tokens[:n]), np.unique(tokens[n - common :])
            assert len(one) == n and len(other) == m
            assert (0, 1) in formed([one, other], lambda key: key)


def test_parities_in_as_many_ranges_as_tokens_tell_large_sets_apart():
    rng = np.random.default_rng(12)
    assert [_odd_bits(n) for n in (1, 256, 257, 5000, 10**7)] == [256, 256, 512, 8192, 65536]
    for n, m in ((1200, 1000), (5000, 4000), (90_000, 80_000)):
        tokens = rng.integers(0, 2**64, n + m, np.uint64)
        for common in (0, m // 2, m):
            one, other = tokens[:n], tokens[n - common : n - common + m]
            apart = _odd_apart(*(_parities(s, _odd_bits(len(s))).tobytes() for s in (one, other)))
            assert apart <= n + m - 2 * common
            assert n > 50_000 or common == m or 180 * apart > 20 * (n + m)
    assert _odd_apart(*[_parities(tokens, 1024).tobytes()] * 2) == 0


def test_prefix_lengths():
    assert [prefix_length(n, 80) for n in (1, 4, 5, 6, 10, 11)] == [1, 1, 2, 2, 3, 3]
