"""Connected components of a graph of any size, by forests of tasks and then large and small stars."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import new_folder, remove_folder

FOREST_LINKS = 1 << 20

_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def star_forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the links connect, as links from each node to the least node of its part."""
    nodes, codes = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = codes[: len(u)], codes[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        if (low == high).all():
            break
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
    inner = label != np.arange(len(nodes))
    return nodes[inner], nodes[label[inner]]


def _forests(most: int):
    """Star forests of a task's links, ``most`` links at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                held.append([c.to_numpy() for c in batch.slice(start, most).columns])
                count += len(held[-1][0])
                if count >= most:
                    yield _forest_of(held)
                    held, count = [], 0
        if held:
            yield _forest_of(held)

    return run


def _forest_of(held: list[list[np.ndarray]]) -> pa.RecordBatch:
    u, v = star_forest(*(np.concatenate(c) for c in zip(*held, strict=True)))
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=_LINKS)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the least of them; edges lead downwards."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and that has none."""
    ends = edges.select("u", F.lit(1).alias("below")).unionAll(edges.select("v", F.lit(0)))
    nodes = ends.groupBy("u").agg(F.sum("below").alias("below"), F.count("*").alias("links"))
    return nodes.filter("below > 1 OR below = 1 AND links > 1").isEmpty()


def component_roots(edges: DataFrame, most: int = FOREST_LINKS) -> DataFrame:
    """From links (u, v) of longs to a row (u, root) for each node but the roots; the root is the
    least node of its component.

    At first each task reduces its own links to star forests, of ``most`` links at a
    time, without a shuffle, and again as long as that leaves fewer tasks' worth of
    them. Where that leaves one forest it is the answer; else large and small stars
    alternate, a few shuffles of the links that remain a round, and rounds grow with
    the logarithm of the number of nodes. Each step is written to the shared folder;
    its table goes when that of the next is there.
    """
    spark = edges.sparkSession

    def table(links: DataFrame) -> tuple[DataFrame, str]:
        path = new_folder(spark, "links")
        links.write.parquet(path)
        return spark.read.schema("u long, v long").parquet(path), path

    def forests(links: DataFrame) -> DataFrame:
        return links.mapInArrow(_forests(most), "u long, v long")

    down = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links, path = table(forests(down))
    tasks = None
    while (left := links.rdd.getNumPartitions()) > 1 and (tasks is None or left < tasks):
        old, tasks = path, left
        links, path = table(forests(links))
        remove_folder(spark, old)
    if left <= 1 and links.count() <= most:
        old = path
        links, path = table(forests(links))
        remove_folder(spark, old)
        return links.select("u", F.col("v").alias("root"))
    while not _are_stars(links):
        old = path
        links, path = table(_small_star(_large_star(links)).distinct())
        remove_folder(spark, old)
    return links.select("u", F.col("v").alias("root"))
