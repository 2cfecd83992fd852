"""Language of documents by inference of multilingual mixtures."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import per_document, slices

#: Bits of a hashed n-gram, and its characters.
BITS, LENGTH = 15, 3
#: Languages of a model: more than have a code of their own.
MAX_LANGUAGES = 8192
#: Mixture inference ends when no share changes by more, or after so many rounds.
CLOSE, ROUNDS = 1e-4, 500
#: Log-likelihood that a further language must add, for each doubling of the text's n-grams.
PENALTY = 2.0
UNKNOWN = "und"


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bins and counts of a text's n-grams: letters in lower case, other runs as one
    space. Without a letter there are none."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    low = points < 128
    letter = np.where(low, (points >= 97) & (points <= 122), False)
    if not low.all():
        rare, back = np.unique(points[~low], return_inverse=True)
        letter[~low] = np.array([chr(c).isalpha() for c in rare.tolist()])[back]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0)
    points = np.where(letter, points, 32)
    points = points[np.concatenate([[True], letter[1:] | letter[:-1]])]
    points = np.concatenate([[32], points, [32]]).astype(np.uint32)
    n = len(points) - LENGTH + 1
    total = np.zeros(n, np.uint32)
    for i in range(LENGTH):
        total = (total ^ points[i : i + n]) * np.uint32(0x9E3779B1)
        total ^= total >> np.uint32(15)
    counts = np.bincount(total >> np.uint32(32 - BITS), minlength=1 << BITS)
    bins = np.flatnonzero(counts)
    return bins, counts[bins].astype(np.float64)


@dataclass(frozen=True)
class Model:
    """Probability of each n-gram in each language: bins x languages."""

    languages: list[str]
    chances: np.ndarray


def _partial_counts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals: dict[str, np.ndarray] = {}
    for part in slices(batches):
        for language, text in zip(part["lang"], part["text"], strict=True):
            bins, counts = grams(text)
            if len(bins):
                totals.setdefault(language, np.zeros(1 << BITS))[bins] += counts
    for language, total in totals.items():
        bins = np.flatnonzero(total)
        yield pd.DataFrame({"lang": language, "bin": bins, "n": total[bins].astype(np.int64)})


def train(docs: DataFrame) -> Model:
    """The n-gram counts of all rows (text, lang) with a language, summed by Spark.

    Each task sends one row per language and n-gram bin, and the driver gets one row per
    language, one after another: 2**BITS sums each, whatever the input.
    """
    sums = (
        docs.where("lang is not null")
        .select("lang", "text")
        .mapInPandas(_partial_counts, "lang string, bin int, n long")
        .groupBy("lang", "bin")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list("bin").alias("bins"), F.collect_list("n").alias("sums"))
    )
    found = {}
    for row in sums.toLocalIterator():
        own = np.full(1 << BITS, 0.1)
        own[row["bins"]] += row["sums"]
        found[row["lang"]] = (own / own.sum()).astype(np.float32)
        if len(found) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = sorted(found)
    chances = np.stack([found.pop(x) for x in names], axis=1) if names else np.zeros((1 << BITS, 0), np.float32)
    return Model(names, chances)


class _Texts:
    """The n-grams of several texts one after another, with their chances."""

    def __init__(self, model: Model, parts: list[tuple[np.ndarray, np.ndarray]]):
        self.sizes = np.array([len(bins) for bins, _ in parts])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.counts = np.concatenate([counts for _, counts in parts])
        self.chances = model.chances[np.concatenate([bins for bins, _ in parts])].astype(np.float64)
        self.total = np.add.reduceat(self.counts, self.starts)

    def part(self, some: np.ndarray) -> _Texts:
        """The texts at these places."""
        out = object.__new__(_Texts)
        inside = np.zeros(len(self.sizes), bool)
        inside[some] = True
        flat = np.repeat(inside, self.sizes)
        out.sizes, out.total = self.sizes[some], self.total[some]
        out.starts = np.concatenate([[0], np.cumsum(out.sizes)[:-1]])
        out.counts, out.chances = self.counts[flat], self.chances[flat]
        return out

    def fitted(self, shares: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shares after expectation-maximisation, their log-likelihoods, and whether they
        have come to rest. Texts whose shares have leave, so long rounds are for few."""
        shares, texts, left = shares.copy(), self, np.arange(len(shares))
        for _ in range(rounds):
            now = shares[left]
            weight = texts.counts / texts._mass(now)
            step = now * np.add.reduceat(texts.chances * weight[:, None], texts.starts, axis=0) / texts.total[:, None]
            shares[left] = step
            moving = np.abs(step - now).max(axis=1) > CLOSE
            if not moving.any():
                left = left[:0]
                break
            if moving.mean() < 0.75:
                texts, left = texts.part(np.flatnonzero(moving)), left[moving]
        likelihood = np.add.reduceat(self.counts * np.log(self._mass(shares)), self.starts)
        resting = np.ones(len(shares), bool)
        resting[left] = False
        return shares, likelihood, resting

    def _mass(self, shares: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", self.chances, np.repeat(shares, self.sizes, axis=0))


def mixtures(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's proportions of the model's languages (rows of zeros without letters),
    its fit: log-likelihood per n-gram over that of all n-grams equally likely, and
    whether all inference it rests on has come to rest.

    Expectation-maximisation runs first over all languages. The likeliest language by
    itself and sets of the two, three and so on strongest are fitted anew, and the set with the best likelihood less
    PENALTY per further language and doubling of the n-grams wins. Sets grow for as
    long as the likelihood of all languages leaves room for a better one.
    """
    k = len(model.languages)
    out, fit, rests = np.zeros((len(texts), k)), np.full(len(texts), np.nan), np.ones(len(texts), bool)
    parts = [grams(t) for t in texts]
    full = np.array([i for i, (bins, _) in enumerate(parts) if len(bins)], np.int64)
    if not len(full) or not k:
        return out, fit, rests
    found = _Texts(model, [parts[i] for i in full])
    everything, bound, resting = found.fitted(np.full((len(full), k), 1 / k))
    place = np.argsort(np.argsort(-everything, axis=1, kind="stable"), axis=1, kind="stable")
    alone = np.add.reduceat(np.log(found.chances) * found.counts[:, None], found.starts, axis=0)
    best = np.eye(k)[alone.argmax(axis=1)]
    score = alone.max(axis=1)
    plain = score.copy()
    price = PENALTY * np.log2(1 + found.total)
    held = None
    for size in range(2, k + 1):
        # All languages together bound the likelihood of every set: most texts are done.
        left = np.flatnonzero(bound - (size - 1) * price > score)
        if not len(left):
            break
        if held is None or len(held) != len(left):
            held, again = left, found.part(left)
        shares, likelihood, still = again.fitted(np.where(place[left] < size, 1 / size, 0.0))
        resting[left] &= still
        worth = likelihood - (size - 1) * price[left]
        better = worth > score[left]
        best[left[better]], score[left[better]], plain[left[better]] = shares[better], worth[better], likelihood[better]
    out[full] = best
    fit[full] = plain / found.total + BITS * np.log(2)
    rests[full] = resting
    return out, fit, rests


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, languages, fit, converged per row of docs.

    lang_pred is the language with the largest share of the whole text, ties to the
    first in order of names, and score its share (0 to 1). A null or empty text, or
    one without a letter, or an empty model gives UNKNOWN with score 0. languages is
    the chosen set with shares. fit tells whether any language fits: below 0 a draw of
    n-grams all equally likely explains the text better than its languages do; it is
    null with UNKNOWN. converged is false where shares still moved after ROUNDS rounds. The model is bounded by its parameters and goes to
    the tasks once. Repeated rows and null ids are kept; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predictions(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for part in slices(batches, 64):
            shares, fits, rests = mixtures(model, list(part["text"]))
            rows = []
            for doc_id, own, fit, rest in zip(part["doc_id"], shares, fits.tolist(), rests.tolist(), strict=True):
                if not own.any():
                    rows.append((doc_id, UNKNOWN, 0.0, {}, None, True))
                    continue
                at = int(own.argmax())
                found = {model.languages[i]: float(own[i]) for i in np.flatnonzero(own)}
                rows.append((doc_id, model.languages[at], min(1.0, float(own[at])), found, fit, rest))
            yield pd.DataFrame(rows, columns=["doc_id", "lang_pred", "score", "languages", "fit", "converged"])

    return per_document(docs, predictions, "lang_pred string, score double, languages map<string,double>, fit double, converged boolean")


def held_out() -> F.Column:
    """Whether a row is kept from training: crc32 of its doc_id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
