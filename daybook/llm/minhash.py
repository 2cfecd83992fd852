"""Near-duplicate documents by MinHash with tensored banding."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import components, mixed, per_document, shingle_set, signed, slices, stored

#: Hashes in each of the two collections, and min-hashes in each of those hashes.
GROUPS, WIDTH = 14, 2
MIN_SIMILARITY = 75
#: Bits of the bitmaps that rule pairs out before their texts meet.
BITMAP = 1024
_FUNCTIONS = mixed(np.arange(1, 2 * GROUPS * WIDTH + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def bands(shingles: np.ndarray) -> np.ndarray:
    """Both collections of hashes of a set, 2 x GROUPS values of WIDTH min-hashes each."""
    least = np.array([(shingles * f).min() for f in _FUNCTIONS]).reshape(2 * GROUPS, WIDTH)
    total = np.zeros(2 * GROUPS, np.uint64)
    for i in range(WIDTH):
        total = mixed(total + least[:, i])
    return total


def _sketches(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in slices(batches):
        rows = []
        for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
            shingles = shingle_set(text)
            high = low = 0
            keys: np.ndarray | None = None
            if len(shingles):
                digest = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
                high, low = int(digest[0]), int(digest[1])
                keys = signed(bands(shingles))
            rows.append((doc_id, len(shingles), high, low, keys))
        yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "high", "low", "bands"])


def sketches(docs: DataFrame) -> DataFrame:
    """Per document the size and a 128-bit digest of its shingle set, and its hashes."""
    return per_document(docs, _sketches, "n_shingles long, high long, low long, bands array<long>")


def table_keys(sets: DataFrame) -> DataFrame:
    """node, i, j, key of each hash table that a set (node, bands) may share.

    Table (i, j) has for its key the pair of hash i of the first and hash j of the
    second collection, so GROUPS squared tables need 2 x GROUPS hashes. A pair can
    only be shared if either hash is: hashes that no other set has are left out
    before pairs are formed, and with them all sets that are like no other.
    """
    hashes = sets.select("node", F.posexplode("bands").alias("slot", "hash"))
    common = hashes.groupBy("slot", "hash").count().where("count > 1").drop("count")
    live = (
        hashes.join(common, ["slot", "hash"])
        .groupBy("node")
        .agg(F.collect_list(F.struct("slot", "hash")).alias("own"))
        .select(
            "node",
            F.filter("own", lambda x: x["slot"] < GROUPS).alias("first"),
            F.filter("own", lambda x: x["slot"] >= GROUPS).alias("second"),
        )
        .where("size(first) > 0 and size(second) > 0")
    )
    return live.select("node", "second", F.explode("first").alias("f")).select(
        "node", "f", F.explode("second").alias("s")
    ).select(
        "node",
        F.col("f.slot").cast("byte").alias("i"),
        F.col("s.slot").cast("byte").alias("j"),
        F.xxhash64("f.slot", "f.hash", "s.slot", "s.hash").alias("key"),
    )


def _confirm(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in slices(batches):
        known: dict[int, np.ndarray] = {}
        keep = []
        for a, b, x, y in zip(part["a"], part["b"], part["text_a"], part["text_b"], strict=True):
            for node, text in ((a, x), (b, y)):
                if node not in known:
                    known[node] = shingle_set(text)
            keep.append(linked(known[a], known[b]))
        yield part.loc[keep, ["a", "b"]]


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """100 * intersection >= MIN_SIMILARITY * union."""
    if 100 * min(len(x), len(y)) < MIN_SIMILARITY * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= MIN_SIMILARITY * (len(x) + len(y) - both)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar enough."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").mapInPandas(_confirm, "a long, b long")


def _first_equal(x: str, y: str, start: int) -> F.Column:
    """Slot of the first hash that two sets have in common, in one collection."""
    part = lambda c: F.slice(c, start + 1, GROUPS)
    return start + F.array_position(F.zip_with(part(x), part(y), lambda a, b: a == b), True) - 1


def _possible(size_a: str, alike_a: str, size_b: str, alike_b: str, bits_a: str = "", bits_b: str = "") -> F.Column:
    """Whether sets can be similar enough, if alike of size members are in any other.

    A bit that only one bitmap has set stands for a member or more that the other set
    lacks, which bounds the intersection further.
    """
    most = F.least(alike_a, alike_b)
    if bits_a:
        word = lambda c, k: F.get(c, F.lit(k))
        lacks = lambda x, y: sum(F.bit_count(word(x, k).bitwiseAND(F.bitwise_not(word(y, k)))) for k in range(BITMAP // 64))
        most = F.least(most, F.col(size_a) - lacks(bits_a, bits_b), F.col(size_b) - lacks(bits_b, bits_a))
    return (100 + MIN_SIMILARITY) * most >= MIN_SIMILARITY * (F.col(size_a) + F.col(size_b))


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """One bit per shingle of BITMAP, by its leading bits."""
    places = np.zeros(BITMAP, np.uint8)
    places[shingles >> np.uint64(65 - BITMAP.bit_length())] = 1
    return np.packbits(places).view(np.int64)


def _bitmaps(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in slices(batches):
        yield pd.DataFrame({"node": part["node"], "bits": [bitmap(shingle_set(t)) for t in part["text"]]})


def _shingles(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in slices(batches):
        found = [signed(shingle_set(t)) for t in part["text"]]
        yield pd.DataFrame({"node": np.repeat(part["node"].to_numpy(), [len(x) for x in found]), "shingle": np.concatenate(found)})


def _open_buckets(
    tables: DataFrame, sets: DataFrame, labels: DataFrame, texts: DataFrame, alike: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows (key, i, j, node, label, bands, size, alike, bits) of buckets in which labels
    differ, and alike: how many shingles of each node any other node of them has."""
    named = tables.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
    rows = stored(named.join(several.select("key"), "key", "left_semi").select("key", "i", "j", "node", "label"), "open")
    if alike is None:
        nodes = rows.select("node").distinct()
        known = texts.join(nodes, "node", "left_semi")
        found = known.mapInPandas(_shingles, "node long, shingle long")
        bits = known.mapInPandas(_bitmaps, "node long, bits array<long>")
        single = found.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
        alone = single.groupBy("node").agg(F.count("*").alias("alone"))
        alike = stored(
            nodes.join(sets.select("node", "size"), "node")
            .join(alone, "node", "left")
            .join(bits, "node")
            .select("node", "size", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("alike"), "bits"),
            "alike",
        )
    return rows.join(alike, "node").join(sets.select("node", "bands"), "node"), alike


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links (a, b) between nodes."""
    label = lambda s: labels.select(F.col("node").alias(s), F.col("label").alias(f"label_{s}"))
    over = components(
        links.join(label("a"), "a", "left")
        .join(label("b"), "b", "left")
        .select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    ).withColumnRenamed("label", "over")
    old = labels.join(over.withColumnRenamed("node", "label"), "label", "left").select("node", F.coalesce("over", "label").alias("label"))
    new = over.join(labels.select("node"), "node", "left_anti").select("node", F.col("over").alias("label"))
    return stored(old.union(new), "merged")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Near-duplicate groups: doc_id, n_shingles, component_id, kept per row of docs.

    Two documents are linked if their sets of five-word shingles have a Jaccard
    similarity of 0.75 or more; a component is what links connect. Candidates come
    from tensored MinHash tables, and each link is confirmed on the full sets. A pair
    at the threshold is missed with a chance of 2 * (1 - 0.75**2)**14, about 2e-5.

    Equal sets are one node. Of a table's bucket each node first meets the smallest
    one only, then the most typical one. Nodes of a bucket that are still not connected
    meet each other, each pair in the first table it shares, unless bitmaps or the
    shingles that no other candidate has rule the link out. So a group of n copies costs about n
    comparisons, and no possible link is dropped.

    A doc_id names one text, links of one with several are those of its least text; a repeated row is in its twin's group. A document without words or text is
    linked with nothing. A null doc_id stands alone: component_id null, kept true.
    Empty input gives an empty result; other columns of docs are ignored.
    """
    known = stored(sketches(docs), "sketches")
    some = known.where("n_shingles > 0 and doc_id is not null")
    sets = stored(
        some.groupBy("high", "low").agg(F.min("doc_id").alias("node"), F.any_value("bands").alias("bands"), F.max("n_shingles").alias("size")), "sets"
    )
    keys = table_keys(sets.select("node", "bands"))
    first = keys.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    tables = stored(keys.join(first.drop("most"), "key"), "tables")
    star = tables.where("node <> least").groupBy("node").agg(F.min("least").alias("least"))

    # Texts of candidates only, one of each set.
    live = tables.select("node").distinct()
    texts = stored(
        docs.select(F.col("doc_id").alias("node"), "text").join(live, "node", "left_semi").groupBy("node").agg(F.min("text").alias("text")),
        "texts",
    )
    links = confirmed(star.select(F.col("least").alias("a"), F.col("node").alias("b")), texts)
    labels = components(links)

    # Members of a bucket with different labels: first each with the most typical one,
    # whose shingles others have too, then every pair left that can be similar enough.
    open_rows, alike = _open_buckets(tables, sets, labels, texts)
    by = F.struct((1 - F.col("alike") / F.col("size")).alias("own"), "node", "label", "size", "alike")
    typical = open_rows.groupBy("key").agg(F.min(by).alias("to"))
    chosen = (
        open_rows.join(typical, "key")
        .where((F.col("label") != F.col("to.label")) & _possible("size", "alike", "to.size", "to.alike"))
        .groupBy("node")
        .agg(F.min("to").alias("to"))
        .select(F.col("to.node").alias("a"), F.col("node").alias("b"))
    )
    labels = _merged(labels, confirmed(chosen, texts))

    open_rows, _ = _open_buckets(tables, sets, labels, texts, alike)
    a, b = (open_rows.select("key", "i", "j", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "label", "bands", "size", "alike", "bits")]) for s in "ab")
    pairs = a.join(
        b,
        (a["key"] == b["key"])
        & (a["i"] == b["i"])
        & (a["j"] == b["j"])
        & (a["label_a"] < b["label_b"])
        & _possible("size_a", "alike_a", "size_b", "alike_b", "bits_a", "bits_b")
        & (_first_equal("bands_a", "bands_b", 0) == a["i"])
        & (_first_equal("bands_a", "bands_b", GROUPS) == a["j"]),
    ).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    labels = _merged(labels, confirmed(pairs, texts))
    final = (
        sets.select("high", "low", "node")
        .join(labels, "node", "left")
        .select("high", "low", F.coalesce("label", "node").alias("label"))
    )
    return (
        known.join(final, ["high", "low"], "left")
        .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("label")).otherwise(F.col("doc_id")))
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)).alias("kept"))
    )
