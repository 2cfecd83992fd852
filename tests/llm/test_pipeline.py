"""The pipeline, stage by stage, against plain versions over a whole small table."""

import os
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from daybook.llm import languages, raking
from test_documents import all_shifts, lowered, removed, shingles, words

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared tables absent")


def plain_near_duplicates(docs):
    sets = {i: shingles(t) for i, t, *_ in docs}
    holders = {}
    for i, own in sets.items():
        for x in own:
            holders.setdefault(x, []).append(i)
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, own in sets.items():
        for j in {j for x in own for j in holders[x] if j < i}:
            both = len(own & sets[j])
            if 100 * both >= 75 * (len(own) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [r for r in docs if root(r[0]) == r[0]]


def held(text, items):
    own = set(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text)))
    some = [(i, t) for i, t, w in items if len(own & w) >= min(len(w), 8)]
    return any(all_shifts(text, t) for _, t in some)


def plain_raking(cells, power, most=None, weight=None):
    """Weights of cells {(source, lang, topic): mass}."""
    total = sum(cells.values())
    weight = dict(weight or dict.fromkeys(cells, 1.0))
    goals = []
    for at in range(3):
        mass = {}
        for c, m in cells.items():
            mass[c[at]] = mass.get(c[at], 0) + m
        share = {v: m**power for v, m in mass.items() if m > 0}
        goals.append({v: s * total / sum(share.values()) for v, s in share.items()})
    for _ in range(400):
        for at in range(3):
            present = {}
            for c, m in cells.items():
                present[c[at]] = present.get(c[at], 0) + m * weight[c]
            for c in cells:
                weight[c] *= goals[at].get(c[at], 0) / present[c[at]] if present[c[at]] else 0
                weight[c] = weight[c] if most is None else min(weight[c], most)
    return weight


def test_every_stage_equals_a_plain_one(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id")
    names = docs.columns
    rows = lambda df: sorted((tuple(r) for r in df.select(names).collect()), key=lambda r: r[0])
    stages = dict(corpus_pipeline.STAGES)

    kept = docs.persist()
    before = rows(kept)
    model = languages.train(kept.select("text", "lang"))
    shares, fit, _ = languages.mixtures(model, [r[1] for r in before])
    plain = [r for r, own, x in zip(before, shares, fit, strict=True) if own.any() and x >= corpus_pipeline.MIN_FIT]
    assert rows(stages["language_id"](spark, kept, SF_DIR)) == plain

    unique = plain_near_duplicates(plain)
    now = spark.createDataFrame(plain, docs.schema)
    assert rows(stages["near_duplicates"](spark, now, SF_DIR)) == unique and len(unique) < len(plain)

    now = spark.createDataFrame(unique, docs.schema)
    cut = rows(stages["repeated_passages"](spark, now, SF_DIR))
    left = removed([r[:2] for r in unique])
    assert [words(r[1]) for r in cut] == [[w for p, w in enumerate(own) if p not in gone] for own, gone in left]
    assert all(r == s for r, s, (_, gone) in zip(cut, unique, left, strict=True) if not gone)
    assert all(r[4] == len(r[1]) for r, (_, gone) in zip(cut, left, strict=True) if gone) and any(gone for _, gone in left)

    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect() if r.text]
    items = [(i, t, set(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(t)))) for i, t in bench]
    clean = [r for r in cut if not held(r[1], items)]
    now = spark.createDataFrame(cut, docs.schema)
    assert rows(stages["benchmark_passages"](spark, now, SF_DIR)) == clean and len(clean) < len(cut)

    now = spark.createDataFrame(clean, docs.schema)
    mixed = {r.doc_id: r for r in stages["mixture"](spark, now, SF_DIR).collect()}
    topics = {r.doc_id: r.topic for r in now.select("doc_id", raking.topic(F.col("text")).alias("topic")).collect()}
    cell = {r[0]: (r[3], r[2], topics[r[0]]) for r in clean}
    cells = {}
    for r in clean:
        cells[cell[r[0]]] = cells.get(cell[r[0]], 0) + len(words(r[1]))
    weight = plain_raking(cells, 0.8)
    # The largest weight that cells but those of 1% of the weighted mass stay below.
    mass = sum(m * weight[c] for c, m in cells.items())
    most, above = 0.0, 0.0
    for c in sorted(cells, key=lambda c: -weight[c]):
        above += cells[c] * weight[c]
        most = weight[c]
        if above > raking.WHOLE * mass:
            break
    if most < max(w for c, w in weight.items() if cells[c]):
        weight = plain_raking(cells, 0.8, most * 1.01, weight)
    chance = {r[0]: min(1.0, weight[cell[r[0]]] / most) if words(r[1]) else 0.0 for r in clean}
    for r in clean:
        seed = xxhash.xxh64_intdigest(r[0].to_bytes(8, "little", signed=True), 42)
        draw = (xxhash.xxh64_intdigest((r[1] or "").encode(), seed) % (1 << 53) + 0.5) / (1 << 53)
        if abs(draw - chance[r[0]]) > 0.03:
            assert (r[0] in mixed) == (draw < chance[r[0]]), r[0]
        if r[0] in mixed:
            assert abs(mixed[r[0]].keep_chance - chance[r[0]]) < 0.03 and mixed[r[0]].n_words == len(words(r[1]))
    assert 0 < len(mixed) < len(clean) and np.isfinite([r.keep_chance for r in mixed.values()]).all()
