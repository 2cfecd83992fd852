"""Removal of passages that occur more than once, by seed and extend."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import PRIME, gram_hashes, mixed, per_document, signed, slices, stored, utf8, word_hashes

#: Words of a window, and of the seed looked for in it.
WINDOW, SEED = 35, 6
#: Seeds of a window; the one with the smallest hash is its anchor.
SEEDS = WINDOW - SEED + 1
_INVERSE = np.uint64(pow(int(PRIME), -1, 1 << 64))
_LEFT, _RIGHT = mixed(np.array([1, 2], np.uint64)) | np.uint64(1)


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of a text: hash, position, first and last window that each stands for.

    Every window has one anchor, the leftmost of its seeds with the smallest hash, so
    equal windows have equal anchors at the same place. The windows of an anchor
    follow one another.
    """
    if len(hashes) < WINDOW:
        empty = np.zeros(0, np.int64)
        return empty.view(np.uint64), empty, empty, empty
    seeds = gram_hashes(hashes, SEED)
    at = np.lib.stride_tricks.sliding_window_view(seeds, SEEDS).argmin(axis=1)
    at = at + np.arange(len(at))
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], len(at)) - 1
    return seeds[at[first]], at[first], first, last


@lru_cache(maxsize=32)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.cumprod(np.full(n, PRIME, np.uint64)), np.cumprod(np.full(n, _INVERSE, np.uint64))


def regions(hashes: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of all words of each anchor's windows and of the anchor's place in them."""
    n = len(hashes)
    powers, back = _powers(1 << n.bit_length())
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[:n])])
    end = last + WINDOW
    words = (sums[end] - sums[first]) * back[first]
    return mixed(words + mixed(((end - first) * 64 + at - first).astype(np.uint64)))


def _seed_rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in slices(batches):
        found = np.concatenate([anchors(word_hashes(utf8(text).split()))[0] for text in part["text"]])
        yield pd.DataFrame({"seed": signed(found)})


def _anchor_rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in slices(batches):
        found = []
        for row, text in zip(part["row"], part["text"], strict=True):
            hashes = word_hashes(utf8(text).split())
            seeds, at, first, last = anchors(hashes)
            if len(at):
                loc = at * 4096 + (at - first) * 64 + (last - first)
                found.append((signed(seeds), signed(regions(hashes, at, first, last)), np.full(len(at), row), loc))
        if found:
            yield pd.DataFrame(dict(zip(("seed", "region", "row", "loc"), map(np.concatenate, zip(*found)), strict=True)))


def _contexts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words before and after each anchor asked for, nearest first, as hashes."""
    for part in slices(batches, 64):
        rows = []
        for row, text, wanted in zip(part["row"], part["text"], part["wanted"], strict=True):
            hashes = signed(word_hashes(utf8(text).split()))
            for x in wanted:
                at, first = x["loc"] // 4096, x["loc"] // 64 % 64
                start = at - first
                end = start + x["loc"] % 64 + WINDOW
                rows.append((x["seed"], row, at, start, hashes[start:at][::-1], hashes[at + SEED : end], x["n"]))
        yield pd.DataFrame(rows, columns=["seed", "row", "at", "start", "before", "after", "n"])


def _padded(arrays: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The arrays as rows of WINDOW - SEED words, and their lengths."""
    arrays = list(arrays)
    sizes = np.array([len(x) for x in arrays])
    out = np.zeros((len(arrays), WINDOW - SEED), np.uint64)
    out[np.arange(WINDOW - SEED)[None] < sizes[:, None]] = np.concatenate(arrays).view(np.uint64)
    return out, sizes


def _agreeing(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """How many leading words two rows share."""
    equal = (x == y) & (np.arange(x.shape[1])[None] < np.minimum(nx, ny)[:, None])
    return np.logical_and.accumulate(equal, axis=1).sum(axis=1)


def _prefix_hashes(x: np.ndarray) -> np.ndarray:
    out = np.zeros((x.shape[0], x.shape[1] + 1), np.uint64)
    for i in range(x.shape[1]):
        out[:, i + 1] = out[:, i] * PRIME + x[:, i]
    return out


def _extend(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Extends each anchor and its reference both ways while their words agree.

    kind 0: words [start, stop) of a row are repeated. kind 1: a window of the row that
    the reference lacks, with a hash of its words, to be looked for elsewhere.

    A window that begins o words before the anchor needs o words on the left and
    WINDOW - SEED - o on the right.
    """
    names = ["kind", "row", "start", "stop", "seed", "words", "n"]
    for x in slices(batches, 4096):
        before, n_before = _padded(x["before"])
        after, n_after = _padded(x["after"])
        left = _agreeing(before, n_before, *_padded(x["ref_before"]))
        right = _agreeing(after, n_after, *_padded(x["ref_after"]))
        least, most = WINDOW - SEED - n_after, n_before
        low, high = np.maximum(least, WINDOW - SEED - right), np.minimum(most, left)
        at, row, seed = (x[c].to_numpy() for c in ("at", "row", "seed"))
        hit = low <= high
        for r, a in ((row, at), (x["ref_row"].to_numpy(), x["ref_at"].to_numpy())):
            yield pd.DataFrame(
                dict(zip(names, (0, r[hit], (a - high)[hit], (a - low)[hit] + WINDOW, 0, 0, 0), strict=True)), columns=names
            )
        o = np.arange(SEEDS)[None]
        rest = (o >= least[:, None]) & (o <= most[:, None]) & ((o < low[:, None]) | (o > high[:, None]))
        i, o = np.nonzero(rest)
        words = _prefix_hashes(before)[i, o] * _LEFT + _prefix_hashes(after)[i, WINDOW - SEED - o] * _RIGHT
        words = signed(mixed(words + o.astype(np.uint64)))
        start = at[i] - o
        yield pd.DataFrame(
            dict(zip(names, (1, row[i], start, start + WINDOW, seed[i], words, x["n"].to_numpy()[i]), strict=True)), columns=names
        )


def _covered(spans: Iterable[dict] | None, n: int) -> np.ndarray:
    """Which of n words lie in any of the spans."""
    if spans is None or not len(spans):
        return np.zeros(n, bool)
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, [x["start"] for x in spans], 1)
    np.add.at(steps, [x["stop"] for x in spans], -1)
    return np.cumsum(steps[:n]) > 0


def repeated_spans(docs: DataFrame) -> DataFrame:
    """row, spans: for rows (row, text) of docs the words that repeated windows cover.

    Anchors that occur once drop out first. Occurrences of an anchor whose windows
    hold the same words throughout are one class: if it has several members, all their
    windows are repeated. Of an anchor with several classes, one member of each meets
    the member of the largest class only and is extended both ways. Windows left over
    are then grouped by their words. So work follows the number of occurrences and
    never its square, and no occurrence is capped.
    """
    texts = docs.select("row", "text")
    found = texts.mapInPandas(_anchor_rows, "seed long, region long, row long, loc long")
    # Written, so that the join below has plain sides and Spark can split an overfull seed.
    common = texts.select("text").mapInPandas(_seed_rows, "seed long").groupBy("seed").count().where("count > 1")
    common = stored(common.select("seed"), "seeds")
    shared = stored(found.join(common, "seed", "left_semi"), "anchors")
    classes = stored(
        shared.groupBy("seed", "region").agg(
            F.count("*").alias("n"), F.min("row").alias("row"), F.min_by("loc", "row").alias("loc")
        ),
        "classes",
    )
    several = classes.groupBy("seed").agg(F.max(F.struct("n", "region")).alias("top"), F.count("*").alias("m")).where("m > 1")
    asked = (
        classes.join(several.select("seed", F.col("top.region").alias("top")), "seed")
        .withColumn("is_ref", F.col("region") == F.col("top"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("seed", "loc", F.when(F.col("is_ref"), -F.col("n")).otherwise(F.col("n")).alias("n"))).alias("wanted"))
    )
    context = stored(
        docs.select("row", "text")
        .join(asked, "row")
        # A repeated row is one context: classes count its places already.
        .dropDuplicates(["row"])
        .mapInPandas(
            _contexts,
            "seed long, row long, at long, start long, before array<long>, after array<long>, n long",
        ),
        "contexts",
    )
    refs = context.where("n < 0").select("seed", *[F.col(c).alias(f"ref_{c}") for c in ("row", "at", "before", "after")])
    extended = stored(
        context.where("n > 0")
        .join(refs, "seed")
        .mapInPandas(_extend, "kind int, row long, start long, stop long, seed long, words long, n long"),
        "extended",
    )
    left = extended.where("kind = 1")
    again = left.groupBy("seed", "words").agg(F.sum("n").alias("n")).where("n > 1").drop("n")
    spans = (
        extended.where("kind = 0")
        .select("row", "start", "stop")
        .union(left.join(again, ["seed", "words"], "left_semi").select("row", "start", "stop"))
        .union(
            shared.join(classes.where("n > 1").select("seed", "region"), ["seed", "region"], "left_semi")
            .withColumn("start", F.expr("loc div 4096 - loc div 64 % 64"))
            .select("row", "start", F.expr(f"start + loc % 64 + {WINDOW}").alias("stop"))
        )
    )
    return spans.groupBy("row").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def _digests(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in slices(batches):
        rows = []
        for doc_id, text, spans in zip(part["doc_id"], part["text"], part["spans"], strict=True):
            words = utf8(text).split()
            gone = _covered(spans, len(words))
            kept = b" ".join(w for w, x in zip(words, gone, strict=True) if not x)
            rows.append((doc_id, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
        yield pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _with_spans(docs: DataFrame) -> DataFrame:
    keyed = docs.withColumn("row", F.xxhash64("doc_id", "text"))
    return keyed.join(repeated_spans(keyed.select("row", "text")), "row", "left").drop("row")


def removal_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 per row of docs after removal of every
    word that a repeated window of WINDOW words covers.

    Windows are judged on the input. A repeated row is another document, so its
    windows are repeated. Null and empty texts have no words and nothing removed;
    texts shorter than a window keep all. A null doc_id is kept. Empty input gives an
    empty result; other columns of docs are ignored.
    """
    marked = _with_spans(docs.select("doc_id", "text"))
    return per_document(marked, _digests, "n_words long, n_removed long, kept_sha256 string", "spans")


def _cut(text: str, spans: list[dict]) -> str:
    """The text without its removed words; what stands between kept words stays."""
    raw = utf8(text)
    places = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    gone = _covered(spans, len(places))
    out, at = [], 0
    for (start, stop), drop in zip(places, gone, strict=True):
        if drop:
            out.append(raw[at:start].rstrip(b" ") if out or at else raw[at:start])
            at = stop
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "surrogatepass").strip()


def _cuts(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without the words of their spans; null without spans."""
    cut = [None if y is None else _cut(x, y) for x, y in zip(texts, spans, strict=True)]
    return pd.Series(cut, index=texts.index, dtype=object)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of docs with repeated passages cut out of their texts; n_chars, if docs
    has it, is counted anew for texts that changed. Documents are never dropped."""
    # The row travels as one column, so no name of it can clash, and moves once.
    rows = docs.select(F.struct("*").alias("doc"), F.xxhash64("doc_id", "text").alias("row"))
    spans = repeated_spans(docs.select(F.xxhash64("doc_id", "text").alias("row"), "text"))
    cut = F.pandas_udf(_cuts, "string")(F.col("doc.text"), F.col("spans"))
    out = rows.join(spans, "row", "left").select("doc", cut.alias("text"))
    whole = {c: F.col("doc")[c] for c in docs.columns}
    if "n_chars" in whole:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        whole["n_chars"] = F.when(F.col("text").isNotNull(), counted).otherwise(whole["n_chars"])
    whole["text"] = F.coalesce("text", whole["text"])
    return out.select(*[x.alias(c) for c, x in whole.items()])
