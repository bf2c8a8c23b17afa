"""Approximate nearest neighbours with learned partitions.

A bounded sample of the vectors gets its exact neighbour graph, the graph is cut
into balanced parts, and a small classifier learns which parts a vector's
neighbours lie in. The classifier puts every row of the table into its most
probable part and sends a query to several; how many is measured on the sample
against brute force. Rows of those parts are ranked by their inner products in
double precision. Parts and queries are worked on in blocks, so the rows of a
task are bounded however a part grows.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import record_batch, written

NEIGHBOURS = 20
QUERY_EVERY = 20
SAMPLE_ROWS = 8192
PARTS = 32
GRAPH_DEGREE = 16
LEAST_PARTED = 20 * GRAPH_DEGREE  # fewer cannot fill the parts with neighbourhoods
TARGET_RECALL = 0.96
BLOCK_ROWS = 1 << 15
QUERY_BLOCK_ROWS = 2048
CELLS = 1 << 21
SEED = 7


def neighbour_graph(vectors: np.ndarray, degree: int, step: int = 128) -> np.ndarray:
    """Rows of each row's nearest others by inner product, in blocks."""
    degree = min(degree, len(vectors) - 1)
    found = []
    for start in range(0, len(vectors), step):
        block = vectors[start : start + step] @ vectors.T
        block[np.arange(len(block)), np.arange(start, start + len(block))] = -np.inf
        found.append(np.argpartition(-block, degree - 1, axis=1)[:, :degree])
    return np.concatenate(found)


def balanced_parts(graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 0.05) -> np.ndarray:
    """Cut the graph into parts of nearly equal size with few links between them.

    Starts from slices of a breadth-first order; then nodes move, those that
    gain most links first, to the part that holds most of their neighbours as
    long as sizes stay within the slack.
    """
    n = len(graph)
    source = np.repeat(np.arange(n), graph.shape[1])
    a, b = np.concatenate([source, graph.ravel()]), np.concatenate([graph.ravel(), source])
    order = np.argsort(a, kind="stable")
    ends = np.searchsorted(a[order], np.arange(n + 1))
    links = b[order]
    seen, queue = np.zeros(n, bool), []
    for root in range(n):
        if not seen[root]:
            seen[root] = True
            queue.append(root)
            at = len(queue) - 1
            while at < len(queue):
                node = queue[at]
                near = links[ends[node] : ends[node + 1]]
                near = np.unique(near[~seen[near]])
                seen[near] = True
                queue.extend(near.tolist())
                at += 1
    part = np.empty(n, np.int64)
    part[queue] = np.arange(n) * parts // n
    sizes = np.bincount(part, minlength=parts)
    most, least = int(np.ceil(n / parts * (1 + slack))), int(n / parts * (1 - slack))
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.int32)
        np.add.at(votes, (a, part[b]), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        moved = 0
        for node in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())].tolist():
            here, there = part[node], best[node]
            if sizes[there] < most and sizes[here] > least:
                part[node] = there
                sizes[there] += 1
                sizes[here] -= 1
                moved += 1
        if not moved:
            break
    return part


@dataclass(frozen=True)
class Router:
    """One hidden layer and a softmax over parts; ``probes`` parts are searched."""

    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    probes: int

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.maximum(unit @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias

    @property
    def parts(self) -> int:
        return len(self.out_bias)


def _learn(unit: np.ndarray, targets: np.ndarray, width: int = 128, epochs: int = 40) -> Router:
    """Adam on the cross entropy with the share of each part among a row and its neighbours."""
    rng = np.random.default_rng(SEED)
    d, parts = unit.shape[1], targets.shape[1]
    weights = [
        rng.normal(0, (2 / d) ** 0.5, (d, width)),
        np.zeros(width),
        rng.normal(0, (1 / width) ** 0.5, (width, parts)),
        np.zeros(parts),
    ]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        order = rng.permutation(len(unit))
        for rows in np.array_split(order, max(1, len(order) // 256)):
            x, y = unit[rows], targets[rows]
            inner = np.maximum(x @ weights[0] + weights[1], 0)
            z = inner @ weights[2] + weights[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            dz = (p - y) / len(rows)
            dh = dz @ weights[2].T * (inner > 0)
            step += 1
            for i, g in enumerate((x.T @ dh, dh.sum(axis=0), inner.T @ dz, dz.sum(axis=0))):
                g = g + 1e-5 * weights[i]
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                scaled = first[i] / (1 - 0.9**step)
                weights[i] -= rate * scaled / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Router(*weights, probes=parts)


def train_router(
    sample: np.ndarray, parts: int, k: int = NEIGHBOURS, target_recall: float = TARGET_RECALL
) -> Router:
    """Partition the sample's neighbour graph, learn to route, and measure how many parts to search.

    Probes: the fewest at which the sample's own rows find ``target_recall`` of
    their k nearest in the sample, held against brute force.
    """
    d = sample.shape[1]
    if parts < 2 or len(sample) <= max(k, GRAPH_DEGREE) + 1:
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    graph = neighbour_graph(unit, GRAPH_DEGREE)
    part = balanced_parts(graph, parts)
    targets = np.zeros((len(sample), parts))
    around = np.concatenate([part[:, None], part[graph]], axis=1)
    np.add.at(targets, (np.arange(len(sample))[:, None], around), 1 / around.shape[1])
    router = _learn(unit, targets)
    logits = router.logits(sample)
    home = logits.argmax(axis=1)
    rank = np.empty_like(logits, dtype=np.int64)
    np.put_along_axis(rank, np.argsort(-logits, axis=1), np.arange(parts)[None, :], 1)
    asked = np.arange(0, len(sample), max(1, len(sample) // 1024))
    needed = []
    for some in np.array_split(asked, max(1, len(asked) // 128)):
        similar = sample[some] @ sample.T
        similar[np.arange(len(some)), some] = -np.inf
        nearest = np.argpartition(-similar, k - 1, axis=1)[:, :k]
        needed.append(np.take_along_axis(rank[some], home[nearest], 1))
    needed = np.concatenate(needed)
    recall = np.array([(needed < p).mean() for p in range(1, parts + 1)])
    probes = int(np.argmax(recall >= target_recall)) + 1
    return Router(router.hidden, router.hidden_bias, router.out, router.out_bias, probes)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def usable_vectors(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """id and v: rows with an id and a vector of the table's commonest length that is not zero and
    has only finite components."""
    rows = table.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("v"))
    sound = rows.filter(
        F.col("id").isNotNull()
        & F.col("v").isNotNull()
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    commonest = sound.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return sound.filter(F.size("v") == (commonest["d"] if commonest else 0))


RESULT = "query_id long, rank int, vec_id long, score double"


def nearest(
    table: DataFrame,
    k: int = NEIGHBOURS,
    query_every: int = QUERY_EVERY,
    sample_rows: int = SAMPLE_ROWS,
    parts: int = PARTS,
    least_parted: int = LEAST_PARTED,
    target_recall: float = TARGET_RECALL,
    block_rows: int = BLOCK_ROWS,
    query_block_rows: int = QUERY_BLOCK_ROWS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The k nearest found of each query, by largest inner product: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by ``query_every``; candidates are
    all rows with another id. Ties go to the smaller id; a query with fewer
    candidates gets all of them. Rows that repeat an id count as one, as near as the
    nearest of them, however many they are; of a score that several ids share, the smaller ids come first. Vectors null, zero, of an unusual length or with a null or
    non-finite component take no part, nor do rows without an id. Tables of fewer
    than ``least_parted`` rows are one part, which makes the search exact.
    The model is fitted on ``sample_rows`` rows at most, those of the least hashes;
    the index holds every row. The rows of a part meet only the queries sent to it,
    block by block; more ``parts``, with a larger sample, suit larger tables whose
    vectors have neighbourhoods. An empty table gives no rows. Other columns are not read.
    """
    vectors = usable_vectors(table, id_column, vector_column)
    counted, n_ids = vectors.groupBy("id").count().agg(F.sum("count"), F.count("*")).first()
    if not counted:
        return table.sparkSession.createDataFrame([], RESULT)
    once_each = vectors
    if n_ids < counted:
        # Rows that repeat id and vector are one, and the sample takes an id once.
        vectors = written(vectors.distinct(), "ann-vectors")
        counted = vectors.count()
        once_each = vectors.groupBy("id").agg(F.min("v").alias("v"))
    sample_frame = once_each.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(sample_rows)
    chosen = sample_frame.select("v").toArrow()["v"].combine_chunks()
    d = len(chosen[0])
    router = train_router(_matrix(chosen, d), parts if counted >= least_parted else 1, k, target_recall)
    shared = table.sparkSession.sparkContext.broadcast(router)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                home = shared.value.logits(_matrix(batch.column(1), d)).argmax(axis=1)
                schema = pa.schema([*batch.schema, ("part", pa.int32())])
                yield record_batch(schema, *batch.columns, home)

    element = dict(table.dtypes)[vector_column]
    index = written(vectors.mapInArrow(place, f"id long, v {element}, part int"), "ann-index")
    sizes = {r["part"]: r["count"] for r in index.groupBy("part").count().collect()}
    # Ids that lie in one part alone, so that those of several parts add up to different ids.
    spread = index.groupBy("id").agg(F.min("part").alias("part"), F.max("part").alias("last"))
    lone = {r["part"]: r["count"] for r in spread.filter("part = last").groupBy("part").count().collect()}
    filled, held = (np.array([n.get(p, 0) for p in range(router.parts)]) for n in (sizes, lone))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(-shared.value.logits(_matrix(batch.column(1), d)), axis=1, kind="stable")
            before = np.cumsum(held[order], axis=1) - held[order]
            wanted = (np.arange(order.shape[1]) < shared.value.probes) | (before < k + 1)
            rows, ranks = np.nonzero(wanted & (filled[order] > 0))
            schema = pa.schema([*batch.schema, ("part", pa.int32())])
            chosen = batch.take(pa.array(rows))
            yield record_batch(schema, *chosen.columns, order[rows, ranks])

    queries = index.filter(F.col("id") % query_every == 0).select("id", "v")
    routed = queries.mapInArrow(route, f"id long, v {element}, part int")
    asked = {r["part"]: r["count"] for r in routed.groupBy("part").count().collect()}
    row_blocks = _per_part({p: -(-n // block_rows) for p, n in sizes.items()})
    query_blocks = _per_part({p: -(-asked.get(p, 0) // query_block_rows) for p in sizes})
    row_side = (
        index.filter(query_blocks > 0)
        .withColumn("block", F.pmod(F.xxhash64("id", "v"), row_blocks).cast("int"))
        .withColumn("query_block", F.explode(F.sequence(F.lit(0), query_blocks - 1)))
    )
    query_side = routed.withColumn(
        "query_block", F.pmod(F.xxhash64("id", "v", F.lit(SEED)), query_blocks).cast("int")
    ).withColumn("block", F.explode(F.sequence(F.lit(0), row_blocks - 1)))
    keys = ["part", "block", "query_block"]
    found = (
        row_side.groupBy(keys)
        .cogroup(query_side.groupBy(keys))
        .applyInArrow(_ranked(k, d), "query_id long, vec_id long, score double")
    )
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _per_part(counts: dict[int, int]) -> Column:
    """The count of the row's part; parts are few."""
    return F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])[F.col("part")]


def _ranked(k: int, d: int):
    """The k nearest ids of a block for each query of a block, scores summed the same way for
    equal vectors so that ties are ties."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if rows.num_rows and queries.num_rows:
            rows = rows.sort_by("id")
            ids, asked = rows["id"].to_numpy(), queries["id"].to_numpy()
            names, starts, owner = np.unique(ids, return_index=True, return_inverse=True)
            held, wanted = (_matrix(t["v"].combine_chunks(), d) for t in (rows, queries))
            step = max(1, CELLS // len(ids))
            for start in range(0, len(asked), step):
                some = wanted[start : start + step]
                near = some @ held.T
                for query, vector, scores in zip(asked[start : start + step], some, near, strict=True):
                    out.append(_best(k, query, vector, scores, names, starts, owner, held))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], []]
        return pa.table(
            {
                "query_id": pa.array(columns[0], pa.int64()),
                "vec_id": pa.array(columns[1], pa.int64()),
                "score": pa.array(columns[2], pa.float64()),
            }
        )

    return run


def _best(k: int, query, vector, scores, names, starts, owner, held) -> tuple[np.ndarray, ...]:
    """Rows come in the order of their ids: names[owner], each from its start."""
    best = np.maximum.reduceat(scores, starts) if len(names) < len(scores) else scores
    best = np.where(names == query, -np.inf, best)
    wanted = min(k, len(names) - int((names == query).sum()))
    if wanted <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    least = np.partition(best, len(best) - wanted)[len(best) - wanted]
    # Of each id that may be among the k, the rows that may be its nearest.
    floor = np.maximum(best, least)
    floor -= 1e-9 * np.maximum(1.0, np.abs(floor))
    floor[names == query] = np.inf
    near = np.flatnonzero(scores >= floor[owner])
    exact = (held[near] * vector).sum(axis=1)
    ids = names[owner[near]]
    order = np.lexsort((ids, -exact))
    _, first = np.unique(ids[order], return_index=True)
    chosen = order[np.sort(first)[:k]]
    return np.full(len(chosen), query), ids[chosen], exact[chosen]
