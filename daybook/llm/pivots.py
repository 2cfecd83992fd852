"""Approximate nearest neighbours by a permutation index with pivot inverted files."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from daybook.llm.common import slices, stored

#: Pivots at most, and the nearest ones that represent a vector (a share, and at least).
PIVOTS, PREFIX_SHARE, MIN_PREFIX = 1024, 0.1, 32
#: Rows of a block of the index, and of queries answered at once.
BLOCK_ROWS, QUERY_ROWS = 8192, 256
#: Vectors of one dimension from which on they are searched by pivots, and dimensions of so many.
PIVOTED, MAX_DIMENSIONS = 256, 64
#: Share of a block that is reranked, the best by footrule; at least MIN_RERANKED.
RERANKED, MIN_RERANKED = 0.1, 400


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The nearest pivots of each vector in order."""
    distance = (pivots**2).sum(axis=1)[None] - 2 * vectors @ pivots.T
    near = np.argpartition(distance, length - 1, axis=1)[:, :length]
    order = np.take_along_axis(distance, near, axis=1).argsort(axis=1, kind="stable")
    return np.take_along_axis(near, order, axis=1)


class InvertedFiles:
    """For each pivot the vectors of a block that have it in their prefix, with its place."""

    def __init__(self, prefixes: np.ndarray, pivots: int):
        self.rows, self.length = prefixes.shape
        flat = prefixes.ravel()
        order = np.argsort(flat, kind="stable")
        self.vector = (order // self.length).astype(np.int32)
        self.place = (order % self.length).astype(np.int16)
        self.start = np.searchsorted(flat[order], np.arange(pivots + 1))

    def footrule(self, prefix: np.ndarray) -> np.ndarray:
        """Spearman's footrule from a query to every vector, a pivot outside a prefix
        counting as at its end.

        Without common pivots it is length * (length + 1); a pivot at places i and j
        takes off 2 * (length - max(i, j)), so only the query's own files are read.
        """
        parts = [slice(self.start[p], self.start[p + 1]) for p in prefix]
        vector = np.concatenate([self.vector[s] for s in parts])
        place = np.concatenate([self.place[s] for s in parts])
        own = np.repeat(np.arange(len(prefix)), [s.stop - s.start for s in parts])
        off = np.bincount(vector, weights=self.length - np.maximum(own, place), minlength=self.rows)
        return self.length * (self.length + 1) - 2 * off


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows that take part: an id, and a vector of finite components that is not zero."""
    v = F.col(column)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & v.isNotNull()).where(
        (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0)
    )


def vector_classes(base: DataFrame, k: int) -> DataFrame:
    """ids, embedding: each vector once, with the k + 1 smallest ids that have it.

    Of equal vectors a query needs no more: each is as near, ties go to the smaller id,
    and one id may be the query's own. Every task drops the others before rows move.
    """
    smallest = Window.partitionBy("embedding").orderBy("vec_id")
    some = base.distinct().withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k + 1)
    return some.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select("ids", "embedding")


def closest(footrule: np.ndarray, take: int) -> np.ndarray:
    """The take smallest, and all that tie with the last of them."""
    return np.flatnonzero(footrule <= np.partition(footrule, take - 1)[take - 1])


def _with_prefixes(rows: DataFrame, shared: Broadcast) -> DataFrame:
    """rows with dim and prefix, their nearest pivots in order; null where a dimension has no pivots."""

    def prefixes(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in slices(batches, 1024):
            out = pd.Series([None] * len(part), index=part.index, dtype=object)
            for dim, own in part.groupby("dim", sort=False):
                if dim in shared.value:
                    pivots = shared.value[dim]
                    near = nearest_pivots(np.array(own["embedding"].tolist(), np.float64), pivots, _length(pivots))
                    out[own.index] = pd.Series(list(near), index=own.index)
            yield part.assign(prefix=out)

    fields = [*rows.schema, *T.StructType.fromDDL("dim int, prefix array<int>")]
    return rows.withColumn("dim", F.size("embedding")).mapInPandas(prefixes, T.StructType(fields))


def _length(pivots: np.ndarray) -> int:
    return min(len(pivots), max(MIN_PREFIX, ceil(PREFIX_SHARE * len(pivots))))


class _Searched:
    """A block of the index that answers queries."""

    def __init__(self, rows: list[tuple], pivots: np.ndarray | None, reranked: float, k: int):
        self.sizes = np.array([len(ids) for ids, *_ in rows])
        self.ids = np.concatenate([np.asarray(ids, np.int64) for ids, *_ in rows])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.matrix = np.array([v for _, v, _ in rows], np.float64)
        self.files = None if pivots is None else InvertedFiles(np.array([p for *_, p in rows]), len(pivots))
        self.take = min(len(rows), max(MIN_RERANKED, ceil(reranked * len(rows))))
        self.k = k

    def nearest(self, query: int, vector: np.ndarray, prefix: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """ids and distances of the k nearest different ids but the query's own."""
        if self.files is None:
            ranked = np.arange(len(self.sizes))
        else:
            ranked = closest(self.files.footrule(prefix), self.take)
        distance = np.sqrt(((self.matrix[ranked] - vector) ** 2).sum(axis=1))
        n = self.sizes[ranked]
        own = self.ids[np.repeat(self.starts[ranked] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        distance = np.repeat(distance, n)
        order = np.lexsort((own, distance))
        order = order[own[order] != query]
        # The nearest place of each id; k of them in order.
        order = order[np.sort(np.unique(own[order], return_index=True)[1])[: self.k]]
        return own[order], distance[order]


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10, reranked: float = RERANKED) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of vectors for each row of
    queries (both vec_id, embedding), by Euclidean distance in double precision, ties
    to the smaller vec_id; never the row of the query's own id.

    Equal vectors are indexed once, with the smallest of their ids. Pivots are a bounded
    sample of the vectors, the first by a hash of their smallest id, for each number of
    dimensions. The index, a table of every vector with its prefix of nearest pivots, is
    dealt into blocks once; a block posts its prefixes in pivot inverted files. Every query
    comes to every block of its dimension (a stated query set against all rows, in blocks), where
    only its own pivots' files are read; the best share by footrule and what ties
    with the last is reranked, so recall does not fall as rows are added. Each block
    returns k different ids per query. Rows of the index never move more than once:
    what is copied to the blocks are queries.

    Vectors that are null, empty, zero, not finite or without an id take no part; others
    meet those of their own number of dimensions, in full where there are fewer than
    PIVOTED of them. More than MAX_DIMENSIONS numbers with as many vectors raise.
    Repeated rows count once. With fewer candidates
    than k all are returned; empty tables give an empty result. Other columns are
    ignored.
    """
    spark = vectors.sparkSession
    base = usable(vectors).select("vec_id", F.col("embedding").cast("array<double>"))
    asked = usable(queries).select("vec_id", F.col("embedding").cast("array<double>")).distinct()
    classes = stored(vector_classes(base, k), "vectors")
    sizes = stored(classes.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")), "dimensions")
    large = {r["dim"]: r["n"] for r in sizes.where(F.col("n") >= PIVOTED).limit(MAX_DIMENSIONS + 1).collect()}
    if len(large) > MAX_DIMENSIONS:
        raise ValueError(f"vectors of more than {MAX_DIMENSIONS} different lengths")
    pivots = {}
    for dim, n in large.items():
        first = classes.where(F.size("embedding") == dim).orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0], "embedding")
        pivots[dim] = np.array([r["embedding"] for r in first.limit(min(PIVOTS, n // 4)).collect()], np.float64)
    shared = spark.sparkContext.broadcast(pivots)

    layout = sizes.select("dim", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    tasks = layout.agg(F.sum("blocks")).first()[0] or 1
    block = F.pmod(F.xxhash64(F.col("ids")[0], "embedding"), F.col("blocks")).cast("int").alias("block")
    rows = _with_prefixes(classes, shared).join(layout, "dim").select("dim", block, F.lit(False).alias("asks"), "ids", "embedding", "prefix")
    to_all = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    asking = _with_prefixes(asked.select(F.array("vec_id").alias("ids"), "embedding"), shared).join(layout, "dim")
    asking = asking.select("dim", to_all, F.lit(True).alias("asks"), "ids", "embedding", "prefix")
    met = rows.union(asking).repartition(min(tasks, 100_000), "dim", "block").sortWithinPartitions("dim", "block", "asks")

    def search(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, gathered, held = None, [], None
        for part in slices(batches, QUERY_ROWS):
            out = []
            for dim, at, asks, ids, embedding, prefix in part.itertuples(index=False, name=None):
                if (dim, at) != current:
                    current, gathered, held = (dim, at), [], None
                if not asks:
                    gathered.append((ids, embedding, prefix))
                    continue
                if held is None and gathered:
                    held, gathered = _Searched(gathered, shared.value.get(dim), reranked, k), []
                if held is not None:
                    found, distance = held.nearest(ids[0], np.asarray(embedding, np.float64), prefix)
                    out.append((np.full(len(found), ids[0]), found, distance))
            if out:
                yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out)), strict=True)))

    found = met.mapInPandas(search, "query_id long, vec_id long, score double")
    near = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(near))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact neighbours that were found."""
    both = exact.select("query_id", "vec_id").distinct()
    hits = both.join(found.select("query_id", "vec_id").distinct(), ["query_id", "vec_id"], "left_semi").count()
    return hits / max(1, both.count())
