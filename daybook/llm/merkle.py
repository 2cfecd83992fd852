"""A Merkle manifest of a table: content-addressed records, proofs by descent from the root."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import stored

#: Consecutive nodes that become one, and the levels of the tree that a record holds.
RUN, LEVELS = 3, 4
#: Nodes below a record.
SPAN = RUN**LEVELS
STEP = "struct<left:string,right:string>"


def digest(*inputs: Column) -> Column:
    """Hexadecimal sha256 of the inputs one after another."""
    return F.sha2(F.concat(*inputs), 256)


def field(x: Column) -> Column:
    """A value with its length in bytes in front, so that fields cannot run together; null is -."""
    text = x.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column) -> Column:
    return digest(*map(field, columns))


@dataclass
class Manifest:
    """leaves: tree, rank, n, digest, row (all columns of the input). levels: records of
    the trees from the leaves up (digest, levels: the children of every node below it).
    roots: tree, digest, depth (records on the way to a leaf). top: the same over the
    trees' roots; None in it."""

    leaves: DataFrame
    levels: list[DataFrame]
    roots: DataFrame
    top: Manifest | None = None

    @property
    def root(self) -> DataFrame:
        """digest: one row, none for an empty table."""
        return (self.top or self).roots.select("digest")


def _ranked(nodes: DataFrame, order: Sequence[Column]) -> DataFrame:
    """nodes (tree, digest, row, tie) with rank, from 0, by order, digest and tie within the
    tree, and n, the tree's size.

    Ranges of (tree, order) are ranked each by itself and meet through a table of one
    row per tree and range, so that a tree with a third of all rows is spread.
    """
    ranged = stored(nodes.repartitionByRange("tree", *order, "digest", "tie").withColumn("part", F.spark_partition_id()), "ranged")
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("tree", "part").agg(F.count("*").alias("m"))
    sizes = sizes.select(
        "tree", "part", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("before"), F.sum("m").over(Window.partitionBy("tree")).alias("n")
    )
    within = F.row_number().over(Window.partitionBy("part", "tree").orderBy(*order, "digest", "tie"))
    ranked = ranged.withColumn("rank", within).join(sizes, ["tree", "part"])
    return ranked.select("tree", (F.col("before") + F.col("rank") - 1).alias("rank"), "n", "digest", "row")


def _parents(level: Column) -> Column:
    """The digests above a level."""
    starts = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / RUN).cast("int"))
    return F.transform(starts, lambda i: F.sha2(F.array_join(F.slice(level, i * RUN + 1, RUN), ""), 256))


def _records(nodes: DataFrame) -> DataFrame:
    """tree, at, n, digest, levels: SPAN consecutive nodes and what stands above them, up
    to one node. Trees that end here are as high as they need, others LEVELS."""
    height = sum((F.col("n") > RUN**j).cast("int") for j in range(LEVELS))
    out = (
        nodes.groupBy("tree", F.expr(f"rank div {SPAN}").alias("at"))
        .agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("nodes"))
        .select("tree", "at", "n", height.alias("height"), F.col("nodes")["digest"].alias("level0"))
    )
    for j in range(1, LEVELS + 1):
        out = out.withColumn(f"level{j}", F.when(F.col("height") >= j, _parents(F.col(f"level{j - 1}"))))
    every = F.array(*[F.col(f"level{j}") for j in range(LEVELS + 1)])
    return out.select(
        "tree", "at", "n", F.element_at(F.element_at(every, F.col("height") + 1), 1).alias("digest"), F.slice(every, 1, F.col("height")).alias("levels"),
        F.col("level0")[0].alias("first"),
    )


def _built(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Records of all levels, and the trees' roots."""
    nodes, levels, roots = leaves.select("tree", "rank", "n", "digest"), [], None
    while True:
        level = stored(_records(nodes), "records")
        levels.append(level)
        done = level.where(F.col("n") <= SPAN).select("tree", "digest", F.lit(len(levels)).alias("depth"))
        roots = done if roots is None else roots.union(done)
        rest = level.where(F.col("n") > SPAN)
        if rest.isEmpty():
            return levels, stored(roots, "roots")
        nodes = rest.select("tree", F.col("at").alias("rank"), F.ceil(F.col("n") / SPAN).alias("n"), "digest")


def manifest(rows: DataFrame, digest: str, tree: str, order: Sequence[str]) -> Manifest:
    """The Merkle trees of rows, one for each value of the column tree, and one over their roots.

    Leaves are the digests in the column named so; in a tree they ascend by order (null
    first), then by digest. RUN consecutive nodes, fewer at the end, even one, become
    their digest until one remains; a lone leaf is its tree's root. The roots in order
    of the trees' values as bytes, null first, likewise give the root.

    Records are written level by level, each holding LEVELS levels of the tree, so the
    number of rounds is the logarithm of the rows to the base SPAN. No task sees more than
    a range of leaves. Rows that are equal throughout are leaves of their own, in any
    order. All columns are carried, whatever their names. No rows give no root.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit(""))
    # Written before it is used, so that the draw stays; it spreads rows that are equal throughout.
    tie = F.rand(3).alias("tie")
    nodes = rows.select(key.alias("tree"), F.col(digest).alias("digest"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), tie)
    by = [F.col("row")[c] for c in order]
    leaves = stored(_ranked(stored(nodes, "nodes"), by), "leaves")
    levels, roots = _built(leaves)
    tops = roots.select(F.lit("").alias("tree"), "digest", F.struct("tree", "depth").alias("row"), F.lit(0.0).alias("tie"))
    above = stored(_ranked(tops, [F.col("row")["tree"]]), "tops")
    return Manifest(leaves, levels, roots, Manifest(above, *_built(above)))


def _steps(levels: Column, place: Column) -> Column:
    """For each level from the leaf up what stands left and right of the path in its run."""

    def step(level: Column, j: Column) -> Column:
        at = F.floor(place / F.pow(F.lit(RUN), j)).cast("int")
        inner = at % RUN
        left = F.array_join(F.slice(level, at - inner + 1, inner), "")
        return F.struct(left.alias("left"), F.array_join(F.slice(level, at + 2, RUN - 1 - inner), "").alias("right"))

    return F.transform(levels, step)


def _descended(levels: list[DataFrame], starts: DataFrame, requests: DataFrame) -> DataFrame:
    """row, digest, roots, path for requests (tree, rank, row), from starts (tree, depth,
    digest, roots, path) down.

    Requests with the same leading digits of their rank descend as one: each record is
    looked up by its digest once, its unselected children join the path, and the next
    digits choose where to go on. Steps below are put before those above, so a path reads
    from the leaf to the root.
    """
    front = None
    for k in reversed(range(len(levels))):
        begin = starts.where(F.col("depth") == k + 1).select("tree", F.lit(0).cast("long").alias("at"), "digest", "roots", "path")
        front = begin if front is None else front.union(begin)
        node = F.expr(f"rank div {SPAN**k}").alias("node")
        asked = requests.select("tree", node, "row") if k == 0 else requests.select("tree", node).distinct().withColumn("row", F.lit(None))
        asked = asked.groupBy("tree", F.expr(f"node div {SPAN}").alias("at")).agg(
            F.collect_list(F.struct(F.expr(f"cast(node % {SPAN} as int)").alias("place"), "row")).alias("asked")
        )
        records = levels[k].select("digest", "levels", "first").dropDuplicates(["digest"])
        met = front.join(asked, ["tree", "at"]).join(records, "digest")

        def below(x: Column) -> Column:
            # A lone leaf is its own root: nothing to choose.
            chosen = F.when(F.size("levels") > 0, F.get(F.get(F.col("levels"), F.lit(0)), x["place"])).otherwise(F.col("first"))
            path = F.concat(_steps(F.col("levels"), x["place"]), F.col("path"))
            return F.struct(x["place"].alias("place"), x["row"].alias("row"), chosen.alias("digest"), path.alias("path"))

        front = met.select("tree", "at", "roots", F.inline(F.transform("asked", below)))
        if k:
            front = stored(front.select("tree", (F.col("at") * SPAN + F.col("place")).alias("at"), "digest", "roots", "path"), "front")
    return front.select("row", "digest", "roots", "path")


def proofs(held: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """row, digest, roots (root, tree's root), path (array of left, right) for leaves.

    requests: rows of held.leaves, or columns tree, rank and row alike; all leaves if
    none are given. The path holds for every level, from the leaf over its tree's root
    to the root, the digests beside it, empty where a node stands alone. Requests for
    ranks that are not there have no row.
    """
    top = held.top
    start = top.roots.select(
        "tree", "depth", "digest", F.array("digest").alias("roots"), F.array().cast(f"array<{STEP}>").alias("path")
    )
    trees = _descended(top.levels, start, top.leaves.select("tree", "rank", "row"))
    starts = stored(
        trees.select("row.tree", "row.depth", "digest", F.concat("roots", F.array("digest")).alias("roots"), "path"), "starts"
    )
    return _descended(held.levels, starts, (held.leaves if requests is None else requests).select("tree", "rank", "row"))


def siblings_digest(path: Column) -> Column:
    """One digest of all the digests of a path."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["left"], h, s["right"]))
