"""Hard negatives, line quality and the Merkle manifest against plain versions."""

import hashlib
import itertools
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import bond, crf, merkle
from daybook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared tables absent")


def hard(rows, is_anchor, least=(50, 100), most=(95, 100)):
    out = set()
    for a, la, va in rows:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(int(x) * int(y) for x, y in zip(va, v, strict=True)), i, lab) for i, lab, v in rows if i != a and len(v) == len(va))
        for p, i, _ in [x for x in scored if x[2] == la][:5]:
            fits = [(s, j) for s, j, lab in scored if lab != la and least[0] * -p <= least[1] * -s and most[1] * -s <= most[0] * -p]
            out |= {(a, i, n + 1, j, -p, -s) for n, (s, j) in enumerate(fits[:3])}
    return out


@pytest.mark.parametrize("scale", [3, 200, 1 << 28])
def test_hard_negatives_equal_all_pairs(spark, monkeypatch, scale):
    rng = np.random.default_rng(scale)
    monkeypatch.setattr(bond, "MOST_ROWS", 90)
    # Small scales give many ties; large ones pass what doubles hold.
    rows = [(i, int(rng.integers(0, 4)), rng.integers(-scale, scale + 1, 37).astype(float)) for i in range(300)]
    rows += [(1000 + i, i % 3, rows[7][2]) for i in range(60)] + [(2000 + i, 1, np.ones(2)) for i in range(4)] + [(3000, 9, np.zeros(0)), (3010, 8, np.zeros(0))]
    frame = spark.createDataFrame([(i, lab, v.tolist()) for i, lab, v in rows + rows[:20]], "vec_id long, label int, embedding array<double>")
    odd = [(5000, None, [1.0] * 37), (5010, 1, None), (5020, 1, [float("nan")] * 37), (5030, 1, [None] * 37), (None, 1, [1.0] * 37), (5040, 1, [float("inf")] * 37)]
    frame = frame.union(spark.createDataFrame(odd, frame.schema)).withColumn("found", F.lit("clash")).withColumn("block", F.lit(None))
    found = bond.hard_negatives(frame, F.col("vec_id") % 10 == 0)
    expected = hard(rows, lambda i: i % 10 == 0)
    assert {tuple(r) for r in found.collect()} == expected and found.count() == len(expected) > 100
    assert bond.hard_negatives(frame.limit(0), F.lit(True)).count() == 0


def test_bounds_drop_rows_before_all_dimensions_are_read():
    rng = np.random.default_rng(1)
    rows = [np.round(rng.normal(size=64) * np.linspace(60, 1, 64)) for _ in range(800)]
    block = bond.Block(np.arange(800), np.zeros(800, int), rows)
    left = []

    def keep(sums, least, most):
        left.append(len(sums))
        return sums + most >= np.partition(sums, len(sums) - 5)[-5] + least

    places, scores = block.scan(rows[0], np.arange(800), keep)
    # What the last dimensions are read of is a part of the rows; then only the best are left.
    assert left[0] == 800 and left[-1] < 400 and len(places) < 20 and all(scores[i] == rows[0] @ rows[p] for i, p in enumerate(places))


def test_scaled_rounds_down(spark):
    frame = spark.createDataFrame([([0.1, -0.1, 0.5, 1e300],)], "v array<double>")
    assert frame.select(bond.scaled(F.col("v"))).first()[0] == [25.0, -26.0, 128.0, 256e300]


def all_sequences(scores, moves):
    """Chance that each line is good, by adding up every sequence of kinds."""
    n = len(scores)
    total, good = 0.0, np.zeros(n)
    for kinds in itertools.product((0, 1), repeat=n):
        weight = np.exp(sum(s for s, k in zip(scores, kinds, strict=True) if k) + sum(moves[a, b] for a, b in zip(kinds, kinds[1:], strict=False)))
        total += weight
        good += weight * np.array(kinds)
    return good / total


def test_marginals_equal_all_sequences():
    rng = np.random.default_rng(2)
    moves = rng.normal(size=(2, 2))
    chains = sorted((rng.normal(size=n) * 2 for n in (1, 2, 3, 7, 9)), key=len, reverse=True)
    ahead, behind = crf.forward_backward(*crf._padded(chains), moves)
    for column, chain in enumerate(chains):
        assert np.allclose(crf._sigmoid(ahead + behind)[: len(chain), column], all_sequences(chain, moves))


def test_fit_follows_the_gradient_of_the_likelihood():
    rng = np.random.default_rng(3)
    chains = [rng.normal(size=(n, crf.WIDTH)) for n in (3, 5, 2, 6)]
    labels = [0, 1, 1, 0]

    def likelihood(model):
        out = 0.0
        for x, y in zip(chains, labels, strict=True):
            s = x @ model.weights
            every = [
                sum(v for v, k in zip(s, kinds, strict=True) if k) + sum(model.moves[a, b] for a, b in zip(kinds, kinds[1:], strict=False))
                for kinds in itertools.product((0, 1), repeat=len(s))
            ]
            out += (s.sum() if y else 0) + model.moves[y, y] * (len(s) - 1) - np.logaddexp.reduce(every)
        theta = np.append(model.weights, model.moves)
        return out / sum(map(len, chains)) - crf.PENALTY / 2 * theta @ theta

    best = crf.fit(chains, labels, 3000)
    for _ in range(30):
        near = crf.Model(best.weights + rng.normal(size=crf.WIDTH) * 0.02, best.moves + rng.normal(size=(2, 2)) * 0.02)
        assert likelihood(best) > likelihood(near)


def test_quality_of_odd_texts(spark, docs_of):
    good, bad = "These are words of a plain line.\nAnother line of other words.", "a### b$$$ c%%%\nd&&& e*** f###"
    docs = [(i, good if i % 3 else bad) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = crf.train(docs_of(docs), labels)
    assert len(crf.train(docs_of(docs), labels, sample_docs=10).weights) == crf.WIDTH
    cases = [(1, good), (2, bad), (3, None), (4, ""), (5, " \n\t"), (None, bad), (6, good), (6, good), (7, (bad + "\n") * 3000), (8, "x" * 200_000)]
    found = [(r.doc_id, r.score, r.predicted) for r in crf.score(docs_of(cases), model).collect()]
    assert sorted(i or 0 for i, *_ in found) == sorted(i or 0 for i, _ in cases)
    assert all(0 <= s <= 1 and p == (s >= 0.7) for _, s, p in found)
    by_id = {i: (s, p) for i, s, p in found}
    assert by_id[1][1] == by_id[6][1] == 1 and by_id[2][1] == by_id[None][1] == by_id[7][1] == 0
    assert by_id[3] == by_id[4] == by_id[5]
    assert crf.score(docs_of([]), model).count() == 0
    untaught = crf.train(docs_of(docs), labels.limit(0))
    assert {r.score for r in crf.score(docs_of(cases), untaught).collect()} == {0.5}


def test_whole_documents_are_judged_by_neighbouring_lines():
    plain = crf.measures(crf.lines_of("one two three\nfour five\n\nsix"))[0]
    x = crf.features(plain)
    third = crf.WIDTH // 3
    assert x.shape == (3, crf.WIDTH) and (x[1, third : 2 * third] == x[0, :third]).all() and (x[1, 2 * third :] == x[2, :third]).all()
    assert not x[0, third : 2 * third].any() and not x[2, 2 * third :].any()


@tables
def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op12_crf"](spark, folder).collect() if r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    for held in (True, False):
        part = [r for r in rows if r.held_out == held]
        kinds = [[r.score for r in part if labels[r.doc_id] == y] for y in (0, 1)]
        ahead = np.mean([(b > a) + (b == a) / 2 for a in kinds[0] for b in kinds[1]])
        assert ahead > 0.93 and np.mean([r.predicted == labels[r.doc_id] for r in part]) > 0.9


def sha(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def plain_tree(leaves):
    """The root, and for each leaf the siblings from it to the root."""
    proofs, level, places = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, p in enumerate(places):
            run = p // 3 * 3
            proofs[k].append(("".join(level[run:p]), "".join(level[p + 1 : run + 3])))
        level = [sha(*level[i : i + 3]) for i in range(0, len(level), 3)]
        places = [p // 3 for p in places]
    return level[0], proofs


def test_manifest_equals_plain_trees(spark):
    sizes = {None: 1, "": 2, "a": 3, "b": 4, "hot": 700, "é": 82, "z": 81, "row": 9, "y": 244}
    rows = [(s, (i * 7919) % n if i % 5 else None, sha(str(s), str(i // 2)), "t", i) for s, n in sizes.items() for i in range(n)]
    # A third of the rows are one row.
    rows += [("hot", 3, sha("copy"), "t", 0)] * 500
    sizes["hot"] += 500
    frame = spark.createDataFrame(rows, "source string, doc_id long, leaf string, tree string, rank long").repartition(7)
    held = merkle.manifest(frame, "leaf", "source", ["doc_id"])
    trees = {}
    for s in sizes:
        own = sorted(((d is not None, d or 0, h) for x, d, h, *_ in rows if x == s))
        trees[s] = (own, *plain_tree([h for *_, h in own]))
    order = sorted(sizes, key=lambda s: (s is not None, (s or "").encode()))
    root, above = plain_tree([trees[s][1] for s in order])
    assert [r.digest for r in held.root.collect()] == [root]
    expected = sorted(
        (repr(s), d, h, root, trees[s][1], trees[s][2][k] + above[n]) for n, s in enumerate(order) for k, (_, d, h) in enumerate(trees[s][0])
    )
    found = merkle.proofs(held).select("row.source", "row.doc_id", "digest", "roots", "path", merkle.folded(F.col("path"), F.col("digest")).alias("f")).collect()
    assert sorted((repr(r.source), r.doc_id or 0, r.digest, *r.roots, [tuple(x) for x in r.path]) for r in found) == expected
    assert {r.f for r in found} == {root}
    some = merkle.proofs(held, held.leaves.where("rank % 50 = 3")).collect()
    assert len(some) == sum(1 for n in sizes.values() for k in range(n) if k % 50 == 3)
    none = merkle.manifest(frame.limit(0), "leaf", "source", ["doc_id"])
    assert none.root.count() == 0 and merkle.proofs(none).count() == 0


def test_a_changed_leaf_does_not_verify(spark):
    rows = [("s", i, sha(str(i))) for i in range(100)]
    held = merkle.manifest(spark.createDataFrame(rows, "source string, doc_id long, leaf string"), "leaf", "source", ["doc_id"])
    root = held.root.first()[0]
    for r in merkle.proofs(held).select("path", merkle.folded(F.col("path"), F.lit(sha("other"))).alias("f")).collect():
        assert r.f != root and len(r.path) == 5


def test_fields_do_not_run_together(spark):
    rows = [("a", "bc"), ("ab", "c"), (None, "abc"), ("-", "abc"), ("", "abc"), ("é", None), ("é" * 100_000, None)]
    found = [r[0] for r in spark.createDataFrame(rows, "x string, y string").select(merkle.leaf(F.col("x"), F.col("y"))).collect()]
    f = lambda v: "-" if v is None else f"{len(v.encode())}:{v}"
    assert found == [sha(f(x), f(y)) for x, y in rows] and len(set(found)) == len(rows)
