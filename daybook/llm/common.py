"""What several operators share: words, hashes, tables between two steps, components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.session import scratch_path

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Documents handled at once inside a task, so that memory does not follow the Arrow batch.
SLICE = 256


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: lineage ends here, and
    a lost executor does not lose it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def per_document(docs: DataFrame, function: Callable, columns: str, *more: str) -> DataFrame:
    """doc_id and the columns that the function makes of batches of (doc_id, text, more).

    Ids pass through Python as text: pandas would turn a null among numbers to floats.
    """
    kind = docs.schema["doc_id"].dataType
    out = docs.select(F.col("doc_id").cast("string"), "text", *more).mapInPandas(function, f"doc_id string, {columns}")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def slices(batches: Iterable[pd.DataFrame], rows: int = SLICE) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.iloc[start : start + rows]


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the input."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k words in a row."""
    n = len(hashes) - k + 1
    total = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        for i in range(k):
            total *= PRIME
            total += hashes[i : i + n]
    return total


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a text, A-Z lower-cased; with
    fewer words one for the whole sequence, without words none."""
    hashes = word_hashes(utf8(text).translate(LOWER).split())
    if len(hashes) < k:
        short = gram_hashes(hashes, len(hashes)) if len(hashes) else hashes
        return mixed(short + np.uint64(len(hashes)))
    return np.unique(mixed(gram_hashes(hashes, k)))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node id reachable over edges (a, b).

    Each round hooks every node to its smallest neighbour, follows the pointers and
    contracts the edges, so the number of rounds is logarithmic. A hub's edges are
    added up map-side before they meet. Nodes without edges have no row.
    """
    links = stored(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "links",
    )
    labels = None
    while not links.isEmpty():
        both = links.select(F.col("a").alias("x"), F.col("b").alias("y")).union(links.select("b", "a"))
        parent = stored(both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("p")), "parent")
        for _ in range(2):
            up = parent.select(F.col("x").alias("p"), F.col("p").alias("pp"))
            parent = parent.join(up, "p").select("x", F.col("pp").alias("p"))
        parent = stored(parent, "parent")
        a = parent.select(F.col("x").alias("a"), F.col("p").alias("pa"))
        b = parent.select(F.col("x").alias("b"), F.col("p").alias("pb"))
        links = stored(
            links.join(a, "a")
            .join(b, "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(),
            "links",
        )
        if labels is None:
            labels = parent.select(F.col("x").alias("node"), F.col("p").alias("label"))
        else:
            step = parent.select(F.col("x").alias("label"), F.col("p").alias("next"))
            labels = labels.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stored(labels, "labels")
