"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import per_document, slices, utf8

#: Labelled documents at most that the model is fitted on, and lines of them at most.
SAMPLE_DOCS, SAMPLE_LINES = 4000, 60_000
#: Lines of a chain when fitting; a longer document is several chains.
CHAIN = 64
#: Steps of the fit, their size, and the weight of the penalty on large weights.
STEPS, RATE, PENALTY = 250, 0.08, 1e-3
#: From this score on a document counts as good.
GOOD = 0.7

_CLASSES = (
    ("upper", bytes(range(65, 91))), ("digit", bytes(range(48, 58))), ("plain", b".,;:'\"()?-"), ("loud", b"!"), ("bar", b"|\t"),
    ("symbol", b"#$%&*+/<=>@[\\]^_`{}~"), ("wide", bytes(range(128, 256))),
)
_KINDS = bytearray(256)
for _i, (_, _members) in enumerate(_CLASSES, 1):
    for _b in _members:
        _KINDS[_b] = _i
_KINDS = bytes(_KINDS)
#: Measures of a line: a constant, shares of the classes, and of words.
MEASURES = ("one", *(name for name, _ in _CLASSES), "word_length", "words", "same_as_last", "repeated_words", "repeated_line")
_BOUNDED = len(MEASURES)
#: Each measure and its root, then those of the line before and the line after.
WIDTH = 3 * (2 * _BOUNDED - 1)


def lines_of(text: str | None) -> list[bytes]:
    """The lines of a text that hold a word; one empty line if there are none."""
    return [x for x in utf8(text).split(b"\n") if x.strip()] or [b""]


def measures(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A row of measures per line, all from 0 to about 1, and the lines' lengths."""
    often = Counter(lines)
    out = np.zeros((len(lines), _BOUNDED))
    sizes = np.zeros(len(lines))
    for i, line in enumerate(lines):
        words = line.split()
        n = len(words)
        visible = sum(map(len, words))
        kinds = line.translate(_KINDS)
        row = [1.0] + [kinds.count(k) / max(1, visible) for k in range(1, len(_CLASSES) + 1)]
        row += [
            min(1.0, visible / max(1, n) / 12),
            min(1.0, np.log1p(n) / 6),
            sum(map(eq, words, words[1:])) / max(1, n - 1),
            1 - len(set(words)) / n if n else 0.0,
            float(often[line] > 1 and n > 0),
        ]
        out[i] = row
        sizes[i] = max(1, visible)
    return out, sizes


def features(base: np.ndarray) -> np.ndarray:
    """The measures of each line and their roots, with those of its neighbours; beyond the
    ends all are 0, their constant too."""
    own = np.concatenate([base, np.sqrt(base[:, 1:])], axis=1)
    none = np.zeros((1, own.shape[1]))
    return np.concatenate([own, np.concatenate([none, own[:-1]]), np.concatenate([own[1:], none])], axis=1)


@dataclass
class Model:
    """weights: of a good line's features. moves: score of a line of kind j after one of
    kind i (0 bad, 1 good)."""

    weights: np.ndarray
    moves: np.ndarray


def _padded(chains: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Chains of scores, longest first, as columns (step, chain); how many reach each step."""
    sizes = np.array([len(c) for c in chains])
    out = np.zeros((sizes.max(), len(chains)))
    for i, c in enumerate(chains):
        out[: len(c), i] = c
    return out, (sizes[None] > np.arange(len(out))[:, None]).sum(axis=1)


def forward_backward(scores: np.ndarray, active: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds that a line is good given the lines up to it, and given those after it.

    With two kinds a message is one number: what good has over bad.
    """
    ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
    ahead[0] = scores[0]
    for t in range(1, len(scores)):
        a = ahead[t - 1, : active[t]]
        step = np.logaddexp(moves[0, 1], moves[1, 1] + a) - np.logaddexp(moves[0, 0], moves[1, 0] + a)
        ahead[t, : active[t]] = scores[t, : active[t]] + step
    for t in range(len(scores) - 2, -1, -1):
        b = scores[t + 1, : active[t + 1]] + behind[t + 1, : active[t + 1]]
        behind[t, : active[t + 1]] = np.logaddexp(moves[1, 0], moves[1, 1] + b) - np.logaddexp(moves[0, 0], moves[0, 1] + b)
    return ahead, behind


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def fit(chains: list[np.ndarray], labels: list[int], steps: int = STEPS) -> Model:
    """Weights of the largest penalised likelihood of the lines' kinds, by gradient steps
    with running moments. Each chain holds the features of its lines; all have its label."""
    pieces = [(c[i : i + CHAIN], y) for c, y in zip(chains, labels, strict=True) for i in range(0, len(c), CHAIN)]
    pieces.sort(key=lambda p: -len(p[0]))
    model = Model(np.zeros(WIDTH), np.zeros((2, 2)))
    if not pieces:
        return model
    flat = np.concatenate([p[0] for p in pieces])
    kinds = np.concatenate([np.full(len(p[0]), p[1], float) for p in pieces])
    sizes = np.array([len(p[0]) for p in pieces])
    column = np.repeat(np.arange(len(pieces)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    active = (sizes[None] > np.arange(sizes[0])[:, None]).sum(axis=1)
    moved = np.zeros((2, 2))
    for (_, y), n in zip(pieces, sizes, strict=True):
        moved[y, y] += n - 1
    theta = np.zeros(WIDTH + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    scores = np.zeros((sizes[0], len(pieces)))
    for step in range(1, steps + 1):
        moves = theta[WIDTH:].reshape(2, 2)
        scores[place, column] = flat @ theta[:WIDTH]
        ahead, behind = forward_backward(scores, active, moves)
        good = _sigmoid((ahead + behind)[place, column])
        expected = np.zeros((2, 2))
        for t in range(1, len(scores)):
            a, b = ahead[t - 1, : active[t]], scores[t, : active[t]] + behind[t, : active[t]]
            logs = np.stack([np.full_like(a, moves[0, 0]), moves[0, 1] + b, moves[1, 0] + a, moves[1, 1] + a + b])
            share = np.exp(logs - logs.max(axis=0))
            expected += (share / share.sum(axis=0)).sum(axis=1).reshape(2, 2)
        gradient = np.concatenate([flat.T @ (kinds - good), (moved - expected).ravel()]) / len(flat) - PENALTY * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta = theta + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(theta[:WIDTH], theta[WIDTH:].reshape(2, 2))


def quality_of(model: Model, texts: Iterable[str | None]) -> list[float]:
    """The chance that a line is good, over all lines of a text by their lengths."""
    found = [measures(lines_of(t)) for t in texts]
    order = sorted(range(len(found)), key=lambda i: -len(found[i][1]))
    if not order:
        return []
    scores, active = _padded([features(found[i][0]) @ model.weights for i in order])
    ahead, behind = forward_backward(scores, active, model.moves)
    good = _sigmoid(ahead + behind)
    out = [0.0] * len(found)
    for column, i in enumerate(order):
        sizes = found[i][1]
        out[i] = float(good[: len(sizes), column] @ sizes / sizes.sum())
    return out


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document takes no part in learning."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES) -> Model:
    """The model of docs (doc_id, text) and labels (doc_id, quality 0 or 1).

    It is fitted on a sample of the labelled documents, the first by a hash of their id:
    sample_docs at most, with sample_lines at most; documents that would pass the lines
    left are passed over. Only their lines' measures come to the driver. Null ids and
    labels teach nothing; of several texts of an id the least counts, of several labels of an id the mean counts, good from 0.5 on.
    Without labels every line is as likely good as bad.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("q"))
    known = known.select("doc_id", (F.col("q") >= 0.5).cast("int").alias("quality"))
    n_lines = F.coalesce(F.regexp_count("text", F.lit("\n")), F.lit(0)) + 1
    drawn = F.xxhash64(F.col("doc_id").cast("string"))
    first = docs.select("doc_id", n_lines.alias("n")).join(known, "doc_id").groupBy("doc_id").agg(F.max("n").alias("n"), F.first("quality").alias("quality"))
    chosen, left = [], sample_lines
    for r in first.orderBy(drawn, "doc_id").limit(sample_docs).collect():
        if r["n"] <= left:
            left -= r["n"]
            chosen.append((r["doc_id"], r["quality"]))
    if not chosen:
        return fit([], [])
    ids = docs.sparkSession.createDataFrame(chosen, docs.select("doc_id").schema.add("quality", "integer"))
    # At most sample_docs rows, so texts are picked where they lie.
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality"))

    def measured(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in slices(batches):
            rows = [measures(lines_of(t))[0].ravel().tolist() for t in part["text"]]
            yield pd.DataFrame({"doc_id": part["doc_id"], "quality": part["quality"], "x": rows})

    rows = sample.select(F.col("doc_id").cast("string"), "text", "quality").mapInPandas(measured, "doc_id string, quality int, x array<double>").collect()
    rows.sort(key=lambda r: r["doc_id"])
    return fit([features(np.array(r["x"]).reshape(-1, _BOUNDED)) for r in rows], [r["quality"] for r in rows])


def score(docs: DataFrame, model: Model, good: float = GOOD) -> DataFrame:
    """doc_id, score (0 to 1, higher: better), predicted (1 from good on) per row of docs.

    Every line of a text is judged by its own measures and its neighbours', in the
    light of all lines before and after it; the chances that lines are good are averaged
    by length. Null and empty texts count as one empty line. Repeated rows and null ids
    are kept; other columns are ignored; empty docs give an empty result.
    """

    def judged(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in slices(batches):
            yield pd.DataFrame({"doc_id": part["doc_id"], "score": quality_of(model, part["text"])})

    out = per_document(docs, judged, "score double")
    return out.withColumn("predicted", (F.col("score") >= good).cast("int"))
