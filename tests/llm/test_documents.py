"""Operators over documents against brute force on small texts."""

import hashlib
import itertools
import random
import re
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daybook.llm import decontaminate, languages, licenses, minhash, raking, substrings, tokens
from daybook.llm.common import components, word_hashes
from daybook.llm.oracle import ORACLE_SQL

WORDS = [f"w{i}" for i in range(400)]
RANDOM = random.Random(5)


def text(n):
    return " ".join(RANDOM.choice(WORDS) for _ in range(n))


def edited(source, places):
    words = source.split()
    for p in places:
        words[p] = "changed" + str(RANDOM.random())
    return " ".join(words)


BASE, LONG, PASSAGE = text(120), text(3000), text(60)
CASES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One  TWO"), (6, BASE), (7, BASE), (8, edited(BASE, [10])),
    (9, edited(BASE, [10, 60])), (10, edited(BASE, range(0, 120, 7))), (11, LONG), (12, LONG[:-3]), (13, text(200) + " " + PASSAGE),
    (14, PASSAGE + " " + text(90)), (15, "la la " * 60), (16, text(34)), (17, text(35)), (18, text(300)), (18, None),
    (None, BASE), (None, None), (20, "é ß 日本語   x"),
]
CASES += [(100 + i, edited(BASE, RANDOM.sample(range(120), RANDOM.randrange(1, 9)))) for i in range(40)]
CASES += [CASES[5], CASES[5]]


def lowered(x):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in x or "")


def words(x):
    return re.findall("[^\x20\x09-\x0d]+", x or "")


def shingles(x):
    w = words(lowered(x))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def test_near_duplicates_equal_brute_force(docs_of):
    cases = [c for c in CASES if c != (18, None)]
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs_of(cases)).collect()}
    sets = {i: shingles(t) for i, t in cases if i is not None}
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    label[a] = label[b] = min(label[a], label[b])
    expected = {(i, len(s), label[i], label[i] == i) for i, s in sets.items()}
    expected |= {(None, len(shingles(t)), None, True) for i, t in cases if i is None}
    assert found == expected
    assert minhash.near_duplicates(docs_of([])).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(50)] + [(130, 200), (7, 7)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 150)} | {200: 100}


def removed(cases, n=35):
    texts = [words(t) for _, t in cases]
    starts = {}
    for d, w in enumerate(texts):
        for i in range(len(w) - n + 1):
            starts.setdefault(tuple(w[i : i + n]), []).append((d, i))
    gone = [set() for _ in texts]
    for places in starts.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + n))
    return [(w, g) for w, g in zip(texts, gone, strict=True)]


def test_removed_passages_equal_brute_force(docs_of):
    found = sorted((tuple(r) for r in substrings.removal_digests(docs_of(CASES)).collect()), key=repr)
    expected = []
    for (i, _), (w, g) in zip(CASES, removed(CASES), strict=True):
        kept = " ".join(x for p, x in enumerate(w) if p not in g)
        expected.append((i, len(w), len(g), hashlib.sha256(kept.encode()).hexdigest()))
    assert found == sorted(expected, key=repr)
    assert substrings.removal_digests(docs_of([])).count() == 0
    cut = substrings.without_repeats(docs_of(CASES))
    assert cut.columns == docs_of([]).columns and cut.count() == len(CASES)
    whole = {r.doc_id: r.text for r in cut.where("doc_id in (10, 13, 16, 18)").collect() if r.text}
    assert whole[16] == dict(CASES)[16] and whole[13] == " ".join(words(dict(CASES)[13])[:200])


def test_partial_matches_that_share_an_anchor(docs_of):
    # Three texts that agree pairwise on other sides of a common middle.
    left, middle, right = text(40), text(12), text(40)
    cases = [(1, f"{left} {middle} {right}"), (2, f"{left} {middle} {text(40)}"), (3, f"{text(40)} {middle} {right}"),
             (4, f"{text(40)} {middle} {text(40)}")]
    found = {r.doc_id: r.n_removed for r in substrings.removal_digests(docs_of(cases)).collect()}
    assert found == {i: len(g) for (i, _), (_, g) in zip(cases, removed(cases), strict=True)}


def test_repeated_rows_leave_text_that_stands_once(docs_of):
    # One row is given twice and shares only a middle with others, never a window.
    for _ in range(6):
        middle = text(12)
        twice = f"{text(40)} {middle} {text(40)}"
        cases = [(1, twice), (1, twice), (None, twice), (None, twice)] + [(i, f"{text(40)} {middle} {text(40)}") for i in (2, 3)]
        found = sorted((r.doc_id or 0, r.n_removed) for r in substrings.removal_digests(docs_of(cases)).collect())
        assert found == sorted((i or 0, len(g)) for (i, _), (_, g) in zip(cases, removed(cases), strict=True))


def test_token_counts_equal_the_library(docs_of):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = ["a" * 999, "aaa  bb\n\n x", "<|endoftext|> a<|endoftext|>", "\x1c\x85\xa0 ²Ⅷ it's 'sx", "🎉é́ ​﻿", " " * 70]
    odd += ["".join(RANDOM.choice("etaoinshrdlu") for _ in range(n)) for n in (2047, 2048, 2049, 30_000)] + ["ab" * 3000, "é" * 2000, "-=" * 2000]
    cases = CASES + [(500 + i, t) for i, t in enumerate(odd)]
    found = sorted((tuple(r) for r in tokens.token_counts(docs_of(cases), public_tokenizers.path("byte_bpe_50k.json")).collect()), key=repr)
    expected = []
    for i, t in cases:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected.append((i, len((t or "").encode()), n, n > 1024))
    assert found == sorted(expected, key=repr)
    assert tokens.token_counts(docs_of([]), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_license_labels(docs_of):
    cases = [
        (1, "x MIT License and\nthe mit-license, CC  BY NC"), (2, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
        (3, "smit license, mit licenses"), (4, None), (5, ""), (None, "gnu general public license"), (6, "apache\nlicense"),
        (7, "redistribution and use in source or binary"),
    ]
    found = {(r.doc_id, r.n_words): r for r in licenses.license_labels(docs_of(cases)).collect()}
    first = found[1, 10]
    assert (first.n_base, first.first_word, first.last_word, first.base_labels) == (3, 1, 7, "cc-by,mit")
    assert (found[2, 16].n_base, found[2, 16].labels, found[2, 16].score) == (0, "mit", 1.0)
    assert (found[3, 4].n_base, found[3, 4].first_word, found[3, 4].labels) == (0, None, "")
    assert found[None, 4].base_labels == "gpl" and found[6, 2].base_labels == "apache"
    assert found[7, 7].labels == "" and (4, 0) in found and (5, 0) in found
    assert licenses.license_labels(docs_of([])).count() == 0
    again = licenses.license_labels(docs_of(cases + cases[:3])).collect()
    assert sorted(map(tuple, again), key=repr) == sorted([tuple(r) for r in found.values()] + [tuple(found[k]) for k in ((1, 10), (2, 16), (3, 4))], key=repr)


def test_license_wording_wrapped_over_lines(docs_of):
    cases = [
        (1, "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and"),
        (2, "# Redistribution and use in source and binary forms, with or without\r\n# modification, are permitted"),
        (3, "Unless required by applicable law or agreed to in writing, software\n  distributed under the License is distributed on an\n  AS IS basis"),
        (4, "all\nrights\nreserved"), (5, "all rights\n\nreserved"), (6, "all of it is\nnot rights\nthat are reserved"), (7, "all the rights are reserved"),
        (8, "the rights of all users are reserved here"), (9, "licensed under CC BY-NC-SA 4.0"), (10, "is licensed\n * under cc\n * by nc, or all rights reserved"),
        (11, "You may not use that file except in compliance with the License."), (12, "use this file except in compliance with the license"),
    ]
    found = {r.doc_id: (r.labels, r.score) for r in licenses.license_labels(docs_of(cases)).collect()}
    assert found == {
        1: ("mit", 1.0), 2: ("bsd", 1.0), 3: ("apache", 1.0), 4: ("all-rights-reserved", 1.0), 5: ("all-rights-reserved", 1.0), 6: ("", 0.0), 7: ("", 0.0),
        8: ("", 0.0), 9: ("cc-by,cc-by-nc-sa", 1.0), 10: ("all-rights-reserved,cc-by,cc-by-nc", 1.0), 11: ("apache", 11 / 12), 12: ("", 0.0),
    }


def test_license_sql_sees_wrapped_wording(spark, docs_of):
    draw = random.Random(4)
    cases = [(i, None if i == 7 else "") for i in (7, 8)]
    for i in range(10, 90):
        parts = []
        for _ in range(draw.randrange(1, 4)):
            own = draw.choice(list(licenses.TEMPLATES) + list(licenses.PHRASES)).split()
            own = [draw.choice(["x", "the", "license"]) if draw.random() < 0.06 else w for w in own][draw.randrange(2) :]
            parts += [w + draw.choice([" ", " ", "\n", "\n# ", ", ", ".\n\n"]) for w in own + draw.choice([[], ["some", "more"]])]
        cases.append((i, "".join(parts).upper() if i % 9 == 0 else "".join(parts)))
    found = licenses.license_labels(docs_of(cases))
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", cases)
    result = connection.execute(ORACLE_SQL["op9_licenses"])
    names = [x[0] for x in result.description]
    expected = result.fetchall()
    assert sorted(map(tuple, found.select(names).collect())) == sorted(expected)
    assert sum(r[names.index("n_base")] == 0 and r[names.index("labels")] != "" for r in expected) > 10


def test_many_places_of_a_phrase_take_time_in_proportion():
    started = time.process_time()
    words_ = licenses.words_of("cc by " * 100_000)
    places = licenses.phrase_places(words_, licenses.PHRASES)["cc by"]
    assert places == list(range(0, 200_000, 2)) and time.process_time() - started < 10


def test_prefix_filter_finds_what_all_pairs_find():
    templates = {" ".join(RANDOM.choice(WORDS[:60]) for _ in range(RANDOM.randrange(3, 15))): f"t{i}" for i in range(30)}
    frequencies = {w.encode(): RANDOM.randrange(50) for w in WORDS[:60]}
    matcher = licenses.Matcher(templates, frequencies, 0.7)
    for _ in range(300):
        text_ = [RANDOM.choice(WORDS[:60]).encode() for _ in range(RANDOM.randrange(1, 30))]
        for t in RANDOM.sample(list(templates), 2):
            text_ += [RANDOM.choice(WORDS[:60]).encode() if RANDOM.random() < 0.2 else w.encode() for w in t.split()]
        every = []
        for t, label in templates.items():
            own = [w.encode() for w in t.split()]
            for at in range(len(text_)):
                hit = sum(a == b for a, b in zip(own, text_[at:], strict=False))
                if hit >= 0.7 * len(own) - 1e-9:
                    every.append((at, at + len(own), label, hit / len(own)))
        inside = lambda b: any(c[1] - c[0] > b[1] - b[0] and c[0] <= b[0] and c[1] >= b[1] for c in every)  # noqa: E731, B023
        assert sorted(matcher.found_in(text_)) == sorted((b[2], b[3]) for b in every if not inside(b))


def test_benchmark_passages(spark, docs_of, monkeypatch):
    item = text(40)
    words_ = item.split()
    swapped = " ".join("other" if i in (5, 14, 23, 33) else w for i, w in enumerate(words_))
    cases = [(1, text(50) + " " + item.upper() + "."), (2, text(20) + "\n" + swapped + " " + text(9)), (3, " ".join(words_[5:20]) + " " + text(9)),
             (4, " ".join(words_[:8]) + " " + text(50)), (5, None), (6, ""), (7, "tiny item here"), (None, item), (8, text(400))]
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "tiny item here"), (5, text(30))], "item_id long, text string")
    for bits in (27, 17):
        # Few bits let seeds pass that the benchmark lacks.
        monkeypatch.setattr(decontaminate, "SEED_BITS", bits)
        found = {r.doc_id: r for r in decontaminate.contaminated(docs_of(cases), bench).collect()}
        assert {i for i, r in found.items() if r.contaminated} == {1, 2, 3, 7, None}
        assert found[1].item_ids == [1] and found[7].item_ids == [4]
        assert (found[2].spans[0].start, found[2].spans[0].stop) == (20, 60)
    twice = decontaminate.contaminated(docs_of(cases + cases[:3]), bench)
    assert sorted((r.doc_id or 0, r.n_hits) for r in twice.collect()) == sorted((i or 0, found[i].n_hits) for i, _ in cases + cases[:3])
    assert decontaminate.contaminated(docs_of(cases), bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contaminated(docs_of([]), bench).count() == 0


def test_any_stretch_of_enough_equal_words_is_a_passage():
    rng = np.random.default_rng(8)
    fixed = [[i % 5 != 4 for i in range(n)] for n in (15, 40, 60)] + [[i != 3 for i in range(13)], [i != 12 for i in range(16)]]
    drawn = [(rng.random(rng.integers(0, 45)) < rng.choice([0.6, 0.75, 0.85, 0.95])).tolist() for _ in range(1500)]
    outcomes = set()
    for equal in fixed + drawn:
        n = len(equal)
        rule = any(5 * sum(equal[a:b]) >= 4 * (b - a) for a in range(n) for b in range(a + 13, n + 1))
        start, stop, share = decontaminate.best_stretch(np.array(equal, bool))
        assert (stop - start >= 13 and share >= 0.8) == rule
        assert rule or equal not in fixed
        outcomes.add(rule)
    assert outcomes == {True, False}
    item = [f"i{k}" for k in range(60)]
    assert seeded(" ".join("other" if k == 12 else w for k, w in enumerate(item[:16])), " ".join(item[:16])) == [(0, 16, 15 / 16)]


def hashes_of(x):
    return word_hashes(licenses.words_of(x))


def seeded(text_, item):
    """The passages of an item around the seeds that both have."""
    x, y = hashes_of(text_), hashes_of(item)
    own, held = (decontaminate.seeds_of(h, [len(y)] if 0 < len(y) < decontaminate.SHORTEST else []) for h in (x, y))
    shifts = {p - q for a, b in zip(own, held, strict=True) for q, s in enumerate(b.tolist()) for p in np.flatnonzero(a == np.uint64(s)).tolist()}
    return decontaminate.passages(x, y, np.array(sorted(shifts), np.int64))


def all_shifts(text_, item):
    """The passages of an item on every shift, without seeds."""
    x, y = hashes_of(text_), hashes_of(item)
    found = []
    for shift in range(-len(y), len(x)):
        low, high = max(0, -shift), min(len(y), len(x) - shift)
        equal = x[low + shift : high + shift] == y[low:high]
        if len(y) < 13:
            found += [(shift, shift + len(y))] if 0 < len(equal) == len(y) and equal.all() else []
        elif 5 * equal.sum() >= 4 * 13 - 2:
            start, stop, share = decontaminate.best_stretch(equal)
            found += [(start + low + shift, stop + low + shift)] if stop > start and share >= 0.8 else []
    merged = []
    for start, stop in sorted(found):
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(stop, merged[-1][1]))
        else:
            merged.append((start, stop))
    return merged


def test_contamination_of_a_table_equals_all_shifts(spark, docs_of):
    draw = random.Random(11)
    vocabulary = [f"v{i}" for i in range(120)]
    say = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items = [say(draw.choice([3, 7, 8, 12, 13, 20, 60])) for _ in range(25)] + [["la"] * 50, ["a", "b"] * 20]
    docs = []
    for i in range(60):
        parts = say(draw.randrange(0, 80))
        for _ in range(draw.randrange(0, 3)):
            item = draw.choice(items)
            start = draw.randrange(0, max(1, len(item) - 14))
            parts += [draw.choice(vocabulary) if draw.random() < 0.15 else w for w in item[start : start + draw.randrange(5, 60)]] + say(4)
        docs.append((i, " ".join(parts)))
    docs += [(100, "la " * 300), (101, "b a " * 70), (102, None), (103, "")]
    bench = spark.createDataFrame([(n, " ".join(x)) for n, x in enumerate(items)], "item_id long, text string")
    found = {r.doc_id: sorted((s.item_id, s.start, s.stop) for s in r.spans) for r in decontaminate.contaminated(docs_of(docs), bench).collect()}
    assert found == {i: sorted((n, *x) for n, item in enumerate(items) for x in all_shifts(t, " ".join(item))) for i, t in docs}
    assert sum(map(bool, found.values())) > 20


def test_differences_of_many_places():
    rng = np.random.default_rng(5)
    x, y = np.flatnonzero(rng.random(9000) < 0.4), np.flatnonzero(rng.random(3000) < 0.5)
    few = x[:50], y[::40]
    assert decontaminate.differences(x, y).tolist() == sorted({p - q for p in x.tolist() for q in y.tolist()})
    assert decontaminate.differences(*few).tolist() == sorted({p - q for p in few[0].tolist() for q in few[1].tolist()})


def test_masks_hit_every_passage():
    # Any passage holds one of these: words, and how many of them are replaced.
    for n, replaced in ((13, 2), (15, 3), (20, 4), (25, 5)):
        gone = np.array([sum(1 << i for i in c) for c in itertools.combinations(range(n), replaced)])
        hit = np.zeros(len(gone), bool)
        for mask in decontaminate.MASKS:
            bits = int(mask[::-1], 2)
            for at in range(n - len(mask) + 1):
                hit |= gone & bits << at == 0
        assert hit.all(), n
    item = [f"i{k}" for k in range(13)]
    for gone in itertools.combinations(range(13), 2):
        text_ = "x " * 30 + " ".join("other" if k in gone else w for k, w in enumerate(item)) + " y"
        assert seeded(text_, " ".join(item)) == [(30, 43, 11 / 13)]
    assert seeded("a tiny item here", "tiny item here") == [(1, 4, 1.0)] and seeded("tiny item", "tiny item here") == []
    started = time.process_time()
    # Every shift of a text that repeats itself is one passage.
    x, y = hashes_of("la " * 20_000), hashes_of("la " * 3000)
    shifts = decontaminate.differences(np.arange(20_000), np.arange(3000))
    assert decontaminate.passages(x, y, shifts) == [(0, 20_000, 1.0)] and time.process_time() - started < 60


def language_rows():
    parts = {"x": ["th", "er", "on", "ing"], "y": ["sch", "ung", "zu", "ß"], "z": ["ción", "ado", "que", "rr"]}
    make = lambda k, n: " ".join("".join(RANDOM.choice(parts[k]) for _ in range(3)) for _ in range(n))
    return make, [(i, make(k, 40), k) for i, k in enumerate(["x", "y", "z"] * 20)]


def test_languages_and_mixtures(spark):
    make, rows = language_rows()
    model = languages.train(spark.createDataFrame([*[(t, k) for _, t, k in rows], (None, "x"), ("abc", None)], "text string, lang string"))
    assert model.languages == ["x", "y", "z"]
    cases = [(1, make("x", 30)), (2, make("y", 90) + " " + make("z", 30)), (3, None), (4, ""), (5, "12 34 !"), (None, make("z", 9))]
    found = {r.doc_id: r for r in languages.predict(spark.createDataFrame(cases, "doc_id long, text string"), model).collect()}
    assert (found[1].lang_pred, found[1].languages) == ("x", {"x": 1.0})
    assert set(found[2].languages) == {"y", "z"} and abs(found[2].languages["y"] - 0.75) < 0.1
    assert [found[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3 and found[None].lang_pred == "z"
    empty = languages.train(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in languages.predict(spark.createDataFrame(cases, "doc_id long, text string"), empty).collect()} == {"und"}


def test_texts_that_no_language_fits_are_rejected(spark):
    make, rows = language_rows()
    unseen = {100: "".join(RANDOM.choice("bcdfgjklmpqvwxyz ") for _ in range(400)), 101: "Это текст о погоде и о природе", 102: "jak máte dnes krásné počasí", 103: "12 34"}
    seen = {200: make("x", 1), 201: make("z", 5), 202: make("x", 30) + " " + make("y", 30)}
    plain = [(i, t, k, "s", len(t)) for i, t, k in rows]
    docs = spark.createDataFrame(plain + [(i, t, None, "s", len(t)) for i, t in (unseen | seen).items()], "doc_id long, text string, lang string, source string, n_chars int")
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert kept == {i for i, *_ in rows} | set(seen)


def test_all_languages_of_a_mixed_text_are_named():
    sounds = {k: [a + b for a in "bcdfghjk" for b in "aeiou"][5 * n : 5 * n + 5] for n, k in enumerate("pqrstuv")}
    make = lambda k, n: " ".join("".join(RANDOM.choice(sounds[k]) for _ in range(3)) for _ in range(n))
    counts = np.full((1 << languages.BITS, len(sounds)), 0.1)
    for at, k in enumerate(sounds):
        bins, n = languages.grams(make(k, 3000))
        counts[bins, at] += n
    model = languages.Model(list(sounds), counts / counts.sum(axis=0))
    for size in range(1, 7):
        shares, fit, rests = languages.mixtures(model, [" ".join(make(k, 80) for k in list(sounds)[:size])])
        assert rests.all()
        assert np.flatnonzero(shares[0]).tolist() == list(range(size)) and fit[0] > 0
        assert np.abs(shares[0][:size] - 1 / size).max() < 0.05


def test_mixtures_have_the_largest_likelihood():
    rng = np.random.default_rng(6)
    for k in (2, 3):
        counts = rng.random((1 << languages.BITS, k)) ** 4 + 1e-3
        model = languages.Model(list("abc")[:k], counts / counts.sum(axis=0))
        steps = np.linspace(0, 1, 101)
        grid = np.array([x for x in itertools.product(steps, repeat=k) if abs(sum(x) - 1) < 1e-9])
        for text_ in ("one two three four five six", "abc", "la la la la", " ".join(WORDS[:90]) + " zebra quilt fox jump over lazy dogs"):
            bins, n = languages.grams(text_)
            likelihood = lambda shares: np.log(model.chances[bins] @ shares.T).T @ n  # noqa: B023, E731
            shares, _, rests = languages.mixtures(model, [text_])
            price = languages.PENALTY * np.log2(1 + n.sum())
            own = likelihood(shares[0]) - (np.count_nonzero(shares[0]) - 1) * price
            size = (grid > 0).sum(axis=1)
            every = likelihood(grid) - (size - 1) * price
            # No single language is better, nor other shares of the chosen ones; of two languages, nothing is.
            chosen = (grid[:, shares[0] == 0] == 0).all(axis=1)
            assert rests.all() and own >= every[(size == 1) | chosen | (k == 2)].max() - 0.02


def test_language_of_odd_tables(spark, docs_of):
    _, rows = language_rows()
    model = languages.train(spark.createDataFrame([(t, k) for _, t, k in rows], "text string, lang string"))
    assert languages.predict(docs_of([]), model).count() == 0
    twice = languages.predict(docs_of([(1, rows[0][1]), (1, rows[0][1]), (None, "x" * 100_000)]).withColumn("languages", F.lit("clash")), model).collect()
    assert [r.lang_pred for r in twice if r.doc_id == 1] == ["x", "x"] and len(twice) == 3
    tie = languages.Model(["b", "c"], np.full((1 << languages.BITS, 2), 1 / (1 << languages.BITS)))
    assert [r.lang_pred for r in languages.predict(docs_of([(1, "word")]), tie).collect()] == ["b"]


def test_raking_meets_targets_and_says_how_far(spark):
    cells = [(a, b, float(RANDOM.randrange(1, 50))) for a in "pqr" for b in "uv"]
    frame = spark.createDataFrame(cells, "a string, b string, mass double")
    shares = {"a": {"p": 0.5, "q": 0.3, "r": 0.2, "none": 0.4}, "b": {"u": 0.25, "v": 0.75}}
    frames = {k: spark.createDataFrame(list(v.items()), f"{k} string, share double") for k, v in shares.items()}
    raked = raking.rake(frame, ["a", "b"], frames)
    found = {(r.margin, r.value): r for r in raking.deviations(raked, ["a", "b"], frames).collect()}
    assert found["a", "none"].target == found["a", "none"].share == 0
    assert len(found) == 6 and abs(found["b", "u"].target - 0.25) < 1e-9 and max(abs(r.deviation) for r in found.values()) < 1e-4
    capped = raking.rake(frame, ["a", "b"], frames, most=1.1)
    assert max(r.weight for r in capped.collect()) <= 1.1 + 1e-9
    assert max(abs(r.deviation) for r in raking.deviations(capped, ["a", "b"], frames).collect()) > 1e-3
    nothing = raking.rake(frame.where("mass < 0"), ["a", "b"], frames)
    assert nothing.count() == 0


def test_raking_equals_plain_fitting(spark):
    cells = [(a, b, float(RANDOM.randrange(1, 50))) for a in "pqr" for b in "uv"] + [("s", "u", 0.0)]
    frame = spark.createDataFrame(cells, "a string, b string, mass double")
    targets = {"a": {"p": 0.5, "q": 0.3, "r": 0.2, "none": 0.4}, "b": {"u": 0.25, "v": 0.75}}
    frames = {k: spark.createDataFrame(list(v.items()), f"{k} string, share double") for k, v in targets.items()}
    found = {(r.a, r.b): r.weight * r.mass for r in raking.rake(frame, ["a", "b"], frames).collect()}
    total = sum(m for *_, m in cells)
    weight = {(a, b): m for a, b, m in cells}
    for _ in range(200):
        for at, key in enumerate("ab"):
            present = {}
            for cell, m in weight.items():
                present[cell[at]] = present.get(cell[at], 0) + m
            there = {v: s for v, s in targets[key].items() if present.get(v)}
            goal = {v: s * total / sum(there.values()) for v, s in there.items()}
            weight = {c: m * goal.get(c[at], 0) / present[c[at]] if present[c[at]] else 0 for c, m in weight.items()}
    assert all(abs(found[c] - m) < 1e-3 * total for c, m in weight.items())


def test_a_rare_value_does_not_set_the_rate(docs_of):
    docs = docs_of([(i, text(20 + i % 50)) for i in range(600)]).withColumn("source", F.when(F.col("doc_id") % 4 == 0, "a").otherwise("b"))
    stray = docs_of([(9000, text(3)), (9001, " \n ")]).withColumn("source", F.lit("stray")).withColumn("lang", F.lit("odd"))
    kept = raking.sampled(docs.union(stray)).collect()
    mass = {x: sum(r.n_words for r in kept if r.source == x) for x in ("a", "b", "stray")}
    assert min(r.keep_chance for r in kept if r.source == "a") > 0.9 and mass["stray"] == 3
    assert abs(mass["a"] / (mass["a"] + mass["b"]) - 1 / (1 + 3**0.8)) < 0.06


def test_sampling_is_calibrated_and_repeatable(docs_of):
    docs = docs_of([(i, text(20 + i % 50)) for i in range(600)]).withColumn("source", F.when(F.col("doc_id") % 4 == 0, "a").otherwise("b"))
    kept = raking.sampled(docs.withColumn("weight", F.lit("clash")), power=0.5)
    again = raking.sampled(docs, power=0.5)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in again.collect()}
    mass = {r.source: r.m for r in kept.groupBy("source").agg(F.sum("n_words").alias("m")).collect()}
    assert abs(mass["a"] / (mass["a"] + mass["b"]) - 1 / (1 + 3**0.5)) < 0.06
    assert raking.sampled(docs_of([])).count() == 0
    assert raking.sampled(docs_of([(1, None), (2, "")])).count() == 0
