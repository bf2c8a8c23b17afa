import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import packing

LENGTHS = (8, 16, 32)


def check(rows, sizes, lengths):
    """Every token of every document is placed once, no bin overflows, and none could be shorter."""
    pieces, held = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece_start, r.n_tokens))
        held[r.bin_id].append((r.bin_offset, r.n_tokens, r.bin_length))
    for doc, size in sizes.items():
        at = 0
        for start, n in sorted(pieces[doc]):
            assert start == at
            at += n
        assert at == size
    for members in held.values():
        at = 0
        for offset, n, _ in sorted(members):
            assert offset == at
            at += n
        assert {m[2] for m in members} == {min(x for x in lengths if x >= at)}
    return sum(m[0][2] for m in held.values())


@pytest.mark.parametrize("shard_pieces", [1 << 17, 50])
def test_everything_is_placed(spark, shard_pieces):
    rng = random.Random(shard_pieces)
    sizes = {i: rng.choice([1, 2, 3, 5, 8, 13, 32, 33, 64, 100]) for i in range(300)}
    frame = spark.createDataFrame(list(sizes.items()), "doc_id long, size long")
    placed = packing.pack_documents(frame, LENGTHS, F.col("size"), shard_pieces=shard_pieces)
    total = check(placed.collect(), sizes, LENGTHS)
    assert sum(sizes.values()) / total > (0.95 if shard_pieces > 300 else 0.8)
    again = packing.pack_documents(frame.repartition(5), LENGTHS, F.col("size"), shard_pieces=shard_pieces)
    assert sorted(map(tuple, placed.collect())) == sorted(map(tuple, again.collect()))
    summary = packing.bins(placed)
    assert summary.filter("n_tokens > bin_length").count() == 0


def plain_best_fit(sizes, capacities):
    """Bins of the given capacities in order: each piece to the fitting bin with least room."""
    room, out = [], []
    for size in sizes:
        fits = [i for i, r in enumerate(room) if r >= size]
        if fits:
            out.append(min(fits, key=lambda i: room[i]))
        else:
            out.append(len(room))
            room.append(capacities[len(room)])
        room[out[-1]] -= size
    return out, room


def test_best_fit():
    rng = np.random.default_rng(2)
    sizes = np.sort(rng.integers(1, 33, 500))[::-1]
    bins, offsets, final = packing.pack(sizes, [32])
    _, room = plain_best_fit(sizes.tolist(), [32] * 500)
    assert sorted(np.bincount(bins, weights=sizes).astype(int)) == sorted(32 - r for r in room)
    assert len(final) == len(room)


def plain_packing(sizes, lengths):
    """Best fit over bins of several lengths; each opens where its cost a token it may hold is least."""

    def cost(i, length):
        to_come = sum(s for s in sizes[i + 1 :] if s <= length - sizes[i])
        tokens = sizes[i] + min(length - sizes[i], to_come)
        return (64 + length + length * length / 2**18) / tokens, length

    rooms, since, filled, out = [], [], [], []
    for i, size in enumerate(sizes):
        fits = [b for b, room in enumerate(rooms) if room >= size]
        if fits:
            own = min(fits, key=lambda b: (rooms[b], since[b]))
        else:
            own = len(rooms)
            rooms.append(min((n for n in lengths if n >= size), key=lambda n: cost(i, n)))
            since.append(i)
            filled.append(0)
        out.append((own, filled[own]))
        rooms[own], since[own], filled[own] = rooms[own] - size, i, filled[own] + size
    return out, [min(n for n in lengths if n >= total) for total in filled]


@pytest.mark.parametrize("seed", range(12))
def test_several_lengths_equal_plain_best_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = [(8, 16, 32), (100, 700, 1000), (2048, 4096, 8192, 16384, 32768), (5, 6, 7)][seed % 4]
    chance = min(0.9, [0.4, 4 / max(lengths), 20 / max(lengths)][seed % 3])
    sizes = np.minimum(rng.geometric(chance, 400), max(lengths))
    sizes = np.sort(sizes)[::-1]
    bins, offsets, final = packing.pack(sizes, lengths)
    placed, shortest = plain_packing(sizes.tolist(), lengths)
    assert list(zip(bins.tolist(), offsets.tolist(), strict=True)) == placed and final == shortest


def test_bins_open_by_cost_and_shrink():
    assert packing.pack(np.array([5]), LENGTHS)[2] == [8]
    bins, _, final = packing.pack(np.array([20, 7, 5]), LENGTHS)
    assert bins.tolist() == [0, 0, 0] and final == [32]
    bins, _, final = packing.pack(np.array([16, 16]), LENGTHS)
    assert sum(final) == 32


def test_defaults_bytes_and_end(docs):
    found = packing.pack_documents(docs((1, "é"), (2, None), (3, ""), (4, "x" * 70000))).collect()
    check(found, {1: 3, 2: 1, 3: 1, 4: 70001}, packing.LENGTHS)


def test_repeats_null_ids_empty_and_columns(spark, docs):
    assert packing.pack_documents(docs()).count() == 0
    rows = [(1, "abc", 7, "z")] * 3 + [(None, "abc", 7, "z")] * 2 + [(2, "y" * 40000, 1, "q")] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, size int, bin_id string")
    found = packing.pack_documents(frame).collect()
    assert sorted(str(r.doc_id) for r in found) == ["1"] * 3 + ["2"] * 4 + ["None"] * 2
    held = defaultdict(list)
    for r in found:
        held[r.bin_id].append((r.bin_offset, r.n_tokens))
    for members in held.values():
        assert [o for o, _ in sorted(members)] == [0, *np.cumsum([n for _, n in sorted(members)])[:-1]]


def test_repeats_are_numbered_in_no_single_task(spark):
    rows = [(None, 5)] * 1000 + [(1, 5)] * 3 + [(2, 5), (2, 6), (None, 6)]
    sized = spark.createDataFrame(rows, "doc_id long, size long").repartition(7)
    numbered = packing._numbered(sized, 10)
    found = sorted(map(tuple, numbered.collect()), key=repr)
    want = [(None, 5, i) for i in range(1, 1001)] + [(1, 5, 1), (1, 5, 2), (1, 5, 3), (2, 5, 1), (2, 6, 1), (None, 6, 1)]
    assert found == sorted(want, key=repr)
    assert "Window" not in numbered._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = packing._numbered(sized, 10).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(dealt) > 1 and max(r["count"] for r in dealt) < 700


def test_documents_without_tokens_are_left_out(spark):
    frame = spark.createDataFrame([(1, 0), (2, 4), (3, None)], "doc_id long, n long")
    assert [r.doc_id for r in packing.pack_documents(frame, LENGTHS, F.col("n")).collect()] == [2]
