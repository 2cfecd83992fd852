"""Hard negatives by branch and bound over columns of dimensions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from math import ceil, floor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import stored

#: Rows of a block at most, and at least where there are enough tasks for all blocks.
MOST_ROWS, LEAST_ROWS = 32_768, 1024
#: Dimensions read between two looks at the bounds: few at first, when they are largest.
READS = (4, 4, 8, 16, 32)
#: Integers up to this are exact as doubles.
EXACT = float(1 << 53)


def scaled(embedding: Column, factor: float = 256.0) -> Column:
    """Each component times factor, rounded down, as a whole double."""

    def one(x: Column) -> Column:
        y = x.cast("double") * factor
        # Larger doubles are whole already and may not fit a long.
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    return F.transform(embedding, one)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows with an id, a label and a vector of finite components."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where("vec_id is not null and label is not null and embedding is not null").where(fine)


class Block:
    """Rows of one number of dimensions, a column per dimension, with each one's range."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: list[np.ndarray]):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        matrix = np.array([rows[i] for i in order], np.float64).reshape(len(rows), -1)
        self.columns = np.ascontiguousarray(matrix.T)
        self.low, self.high = matrix.min(axis=0), matrix.max(axis=0)
        self.largest = np.maximum(np.abs(self.low), np.abs(self.high))

    def scan(self, anchor: np.ndarray, places: np.ndarray, keep: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Places whose score could count, and their exact scores.

        Dimensions are read by descending magnitude of the anchor. keep is given the
        sums so far and the least and most that the dimensions left can add, which the
        block's ranges bound, and says which places stay.
        """
        order = np.argsort(-np.abs(anchor), kind="stable")
        a = anchor[order]
        least = np.minimum(a * self.low[order], a * self.high[order])
        most = np.maximum(a * self.low[order], a * self.high[order])
        if (np.abs(a) * self.largest[order]).sum() >= EXACT:
            # Too large for doubles: whole numbers of any size, without bounds.
            sums = sum((int(x) * np.array([int(y) for y in self.columns[d, places]], object) for x, d in zip(a, order, strict=True)), np.zeros(len(places), object))
            stay = keep(sums, 0, 0)
            return places[stay], sums[stay]
        sums = np.zeros(len(places))
        read = 0
        for n in [*READS, *[READS[-1]] * (len(a) // READS[-1] + 1)]:
            dims = order[read : read + n]
            if not len(dims) or not len(places):
                break
            part = self.columns[dims]
            sums = sums + a[read : read + n] @ (part if len(places) == len(self.ids) else part[:, places])
            read += len(dims)
            stay = keep(sums, least[read:].sum(), most[read:].sum())
            places, sums = places[stay], sums[stay]
        return places, sums


def _best(scores: np.ndarray, k: int) -> float:
    """The k-th largest score."""
    return np.partition(scores, len(scores) - k)[len(scores) - k]


def _top(block: Block, places: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
    """id and score of the k highest, ties to the smaller id (places ascend by id)."""
    order = np.argsort(-scores, kind="stable")[:k]
    return [(int(block.ids[places[i]]), int(scores[i])) for i in order]


def positives_in(block: Block, anchor: np.ndarray, own: int, label: int, k: int) -> list[tuple[int, int]]:
    """The k highest rows of the anchor's label in a block."""
    places = np.flatnonzero((block.labels == label) & (block.ids != own))

    def keep(sums: np.ndarray, least: float, most: float) -> np.ndarray:
        if len(sums) <= k:
            return np.ones(len(sums), bool)
        return sums + most >= _best(sums, k) + least

    return _top(block, *block.scan(anchor, places, keep), k)


def negatives_in(
    block: Block, anchor: np.ndarray, own: int, label: int, windows: list[tuple[int, int]], k: int
) -> list[list[tuple[int, int]]]:
    """For each window the k highest rows of other labels in a block that score within it."""
    places = np.flatnonzero((block.labels != label) & (block.ids != own))
    lows, highs = [w[0] for w in windows], [w[1] for w in windows]

    def keep(sums: np.ndarray, least: float, most: float) -> np.ndarray:
        stay = np.zeros(len(sums), bool)
        for low, high in zip(lows, highs, strict=True):
            # Rows that are within the window whatever comes raise its lower end.
            sure = sums[(sums + least >= low) & (sums + most <= high)]
            if len(sure) >= k:
                low = max(low, _best(sure, k) + least)
            stay |= (sums + most >= low) & (sums + least <= high)
        return stay

    places, scores = block.scan(anchor, places, keep)
    out = []
    for low, high in windows:
        fits = (scores >= low) & (scores <= high)
        out.append(_top(block, places[fits], scores[fits], k))
    return out


def _met(rows: DataFrame, anchors: DataFrame, blocks: int) -> DataFrame:
    """Rows once and anchors in every block, rows first: a stated query set against all
    rows, in blocks. Anchors alone are copied, a small share of the rows."""
    row = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("asks"), "vec_id", "label", "embedding", F.lit(None).alias("found"))
    to_all = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    asking = anchors.select(to_all, F.lit(True).alias("asks"), "vec_id", "label", "embedding", "found")
    return row.union(asking).repartition(blocks, "block").sortWithinPartitions("block", "asks")


def _scanned(batches: Iterable[pd.DataFrame], answer: Callable) -> Iterator[pd.DataFrame]:
    """Gathers a block's rows, then answers its anchors as they come."""
    current, gathered, held = None, [], {}
    for batch in batches:
        out = []
        for block, asks, vec_id, label, embedding, found in batch.itertuples(index=False, name=None):
            if block != current:
                current, gathered, held = block, [], {}
            if not asks:
                gathered.append((vec_id, label, np.asarray(embedding, np.float64)))
                continue
            if gathered:
                sizes: dict[int, list] = {}
                for x in gathered:
                    sizes.setdefault(len(x[2]), []).append(x)
                held = {
                    n: Block(np.array([x[0] for x in part]), np.array([x[1] for x in part]), [x[2] for x in part]) for n, part in sizes.items()
                }
                gathered = []
            anchor = np.asarray(embedding, np.float64)
            if len(anchor) in held:
                out.extend(answer(held[len(anchor)], anchor, vec_id, label, found))
        if out:
            yield pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score", "vec_id", "score"])


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, least: tuple[int, int] = (50, 100), most: tuple[int, int] = (95, 100)
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    vectors: vec_id, label and embedding, an array of whole numbers (see scaled). Rows
    for which anchors holds are anchors. A row's score is its inner product with the
    anchor, higher first, ties to the smaller vec_id. An anchor's positives are its first
    rows of its label, its negatives for each of them the first rows of other labels
    whose score is at least the share least of the positive's and at most the share most,
    both given as whole numbers (part, of): nothing is lost to rounding.

    Blocks of at most MOST_ROWS rows hold a column per dimension. For each anchor they are
    read by its descending magnitudes; what the dimensions left can add at least and at
    most shrinks the candidates until those left have exact scores. So the result is exact.
    Blocks are drawn by a hash of vec_id, so a label with a third of all rows is no hot
    key. The work is anchors times rows; anchors are copied to every block, rows never.

    Rows with a null id, label, vector or component, or one that is not finite, take no
    part. An id given more than once counts once, by its smallest label and vector.
    Vectors of other lengths than the anchor's do not meet it, nor do rows of its own id.
    Fewer candidates than asked for are all returned; empty tables give an empty result;
    other columns are ignored. Scores beyond 64 bits raise.
    """
    spark = vectors.sparkSession
    asks = anchors.alias("asks")
    one = usable(vectors).select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"), asks)
    one = one.groupBy("vec_id").agg(F.min(F.struct("label", "embedding", "asks")).alias("row")).select("vec_id", "row.*")
    rows = stored(one, "vectors")
    n = rows.count()
    blocks = ceil(n / min(MOST_ROWS, max(LEAST_ROWS, n // (2 * spark.sparkContext.defaultParallelism)))) if n else 1
    asked = rows.where("asks").select("vec_id", "label", "embedding")
    schema = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"

    def nearest(block: Block, anchor: np.ndarray, own: int, label: int, found: object) -> list[tuple]:
        return [(own, None, None, i, s) for i, s in positives_in(block, anchor, own, label, positives)]

    none = F.lit(None).cast("array<struct<vec_id:bigint,score:bigint>>").alias("found")
    candidates = _met(rows, asked.select("*", none), blocks).mapInPandas(lambda b: _scanned(b, nearest), schema)
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    best = candidates.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    best = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.array_sort(F.collect_list(F.struct("vec_id", "score"))).alias("found"))
    paired = stored(asked.join(best, "vec_id"), "positives")

    def window(score: int) -> tuple[int, int]:
        return -(-score * least[0] // least[1]), score * most[0] // most[1]

    def hard(block: Block, anchor: np.ndarray, own: int, label: int, found: list) -> list[tuple]:
        windows = [window(int(x["score"])) for x in found]
        hits = negatives_in(block, anchor, own, label, windows, negatives)
        return [(own, x["vec_id"], x["score"], i, s) for x, part in zip(found, hits, strict=True) for i, s in part]

    chosen = _met(rows, paired, blocks).mapInPandas(lambda b: _scanned(b, hard), schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    return (
        chosen.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
