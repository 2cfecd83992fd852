"""License scan: phrases, and templates contained in blocks of text by an exact join."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import per_document, slices, utf8

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Sentences of published licenses and notices, with the label of each, as
# words in lower case.
TEMPLATES = {
    "this work is licensed under the gnu general public license version": "gpl",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl",
    "you should have received a copy of the gnu general public license along with this program": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license": "lgpl",
    "you should have received a copy of the gnu lesser general public license along with this library": "lgpl",
    "you should have received a copy of the gnu affero general public license along with this program": "agpl",
    "licensed under the apache license version": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis": "apache",
    "without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license": "apache",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software": "mit",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely": "zlib",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license": "boost",
    "licensed under cc by": "cc-by",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by nd": "cc-by-nd",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nc sa": "cc-by-nc-sa",
    "licensed under cc by nc nd": "cc-by-nc-nd",
    "this work is licensed under a creative commons attribution license": "cc-by",
    "this work is licensed under the creative commons attribution sharealike": "cc-by-sa",
    "this work is licensed under the creative commons attribution noncommercial": "cc-by-nc",
    "all rights reserved": "all-rights-reserved",
}
#: Share of a template's words that a block must hold, each in its place.
CONTAINMENT = 0.9
_TO_SPACE = bytes(
    32 if c <= 0x2F or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c + 32 if 65 <= c <= 90 else c
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased runs of digits, letters and everything beyond ASCII."""
    return utf8(text).translate(_TO_SPACE).split()


def word_frequencies(docs: DataFrame, templates: dict[str, str]) -> dict[bytes, int]:
    """In how many documents each word of the templates stands, over all of docs.

    As many rows as the templates have words, which are parameters.
    """
    vocabulary = {w for t in templates for w in words_of(t)}

    def counts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["text"]:
                total.update(vocabulary.intersection(words_of(text)))
        yield pd.DataFrame({"word": list(total), "n": list(total.values())})

    rows = docs.select("text").mapInPandas(counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in rows.collect()}


def _need(size: int, containment: float) -> int:
    return ceil(containment * size - 1e-9)


class Matcher:
    """Finds every template that a block of a text contains to the threshold.

    A block is as many words in a row as the template has, wherever lines end; it contains
    the template if so many of its words stand in their place. Of all texts, the exact join
    by sets leaves those that hold enough of a template's different words. Words are
    ordered by frequency over all documents, rarest first: a text that holds at least need
    of them holds one of the first size - need + 1 (prefix), has need different
    words at least (length), and after position p can gain size - p more (position).
    """

    def __init__(self, templates: dict[str, str], frequencies: dict[bytes, int], containment: float = CONTAINMENT):
        self.templates = []
        self.prefixes: dict[bytes, list[int]] = {}
        for text, label in templates.items():
            whole = words_of(text)
            words = sorted(set(whole), key=lambda w: (frequencies.get(w, 0), w))
            # A place that differs costs one different word at most.
            need = max(1, len(words) - (len(whole) - _need(len(whole), containment)))
            for word in words[: len(words) - need + 1]:
                self.prefixes.setdefault(word, []).append(len(self.templates))
            self.templates.append((words, need, label, whole, _need(len(whole), containment)))

    def held(self, own: set[bytes]) -> list[int]:
        """The templates that a set of words can contain."""
        out = []
        for i in sorted({i for w in own & self.prefixes.keys() for i in self.prefixes[w]}):
            words, need, *_ = self.templates[i]
            if len(own) < need:
                continue
            hit = 0
            for p, word in enumerate(words):
                if hit + len(words) - p < need:
                    break
                hit += word in own
            if hit >= need:
                out.append(i)
        return out

    def found_in(self, words: list[bytes]) -> list[tuple[str, float]]:
        """Label and containment of the templates that blocks of a text contain. Inside a
        block of a longer one, a template is part of it and not named."""
        some = self.held(set(words))
        if not some:
            return []
        sought = {w for i in some for w in self.templates[i][3]}
        places: dict[bytes, list[int]] = {}
        for p, word in enumerate(words):
            if word in sought:
                places.setdefault(word, []).append(p)
        blocks = []
        for i in some:
            _, _, label, whole, need = self.templates[i]
            starts = np.concatenate([np.array(places.get(w, ()), np.int64) - j for j, w in enumerate(whole)])
            starts, hits = np.unique(starts[starts >= 0], return_counts=True)
            blocks += [(s, s + len(whole), label, h / len(whole)) for s, h in zip(starts.tolist(), hits.tolist(), strict=True) if h >= need]
        # From the left, the longer first: a block lies in a longer one if one that begins no later ends no sooner.
        blocks.sort(key=lambda b: (b[0], -b[1]))
        out, end, longest = [], -1, 0
        for start, stop, label, share in blocks:
            if stop > end or stop - start == longest:
                out.append((label, share))
            if stop > end:
                end, longest = stop, stop - start
        return out


def phrase_places(words: list[bytes], phrases: Iterable[str]) -> dict[str, list[int]]:
    """Where each phrase starts, in words; places may overlap."""
    line = b" " + b" ".join(words) + b" "
    out = {}
    for phrase in phrases:
        sought = b" " + phrase.encode() + b" "
        at, last, n, starts = line.find(sought), 0, 0, []
        while at >= 0:
            n += line.count(b" ", last, at)
            starts.append(n)
            at, last = line.find(sought, at + 1), at
        if starts:
            out[phrase] = starts
    return out


def license_labels(
    docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None, containment: float = CONTAINMENT
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per
    row of docs.

    n_base counts all places of the phrases, first_word and last_word are the smallest
    and largest start (null if none), base_labels their labels. labels adds those of
    templates that a block of the text contains (see Matcher), wherever lines end; score
    is the largest containment, 1 with a phrase, else 0. Labels are distinct, sorted and comma-joined, empty if none. Null and empty
    texts have no words. Texts are scanned whole; repeated rows and null ids are kept;
    other columns are ignored.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    matcher = Matcher(templates, word_frequencies(docs, templates), containment)

    def scan(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in slices(batches):
            rows = []
            for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
                words = words_of(text)
                places = phrase_places(words, phrases)
                starts = [x for own in places.values() for x in own]
                base = {phrases[p] for p in places}
                more = matcher.found_in(words)
                score = 1.0 if base else max((s for _, s in more), default=0.0)
                rows.append(
                    (
                        doc_id,
                        len(words),
                        len(starts),
                        min(starts, default=None),
                        max(starts, default=None),
                        ",".join(sorted(base)),
                        ",".join(sorted(base | {x for x, _ in more})),
                        score,
                    )
                )
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
            yield pd.DataFrame(rows, columns=names).astype({"first_word": "Int64", "last_word": "Int64"})

    return per_document(
        docs,
        scan,
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    )
