"""Benchmark passages in documents, found by spaced seeds and checked word by word."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import PRIME, gram_hashes, mixed, signed, slices, stored, word_hashes
from daybook.llm.licenses import words_of

# Masks over words in a row; words at 0 are ignored. They were searched so
# that one of them hits every 13 words with 2 replaced, 15 with 3, 20 with 4 and 25 with 5.
# No passage is missed then: one of 26 words or more has a half that is a passage, and a
# shorter one holds such a row of words with as many replaced or fewer.
MASKS = ("11101111", "11010010111", "111110011", "1100100010111", "1110101001001", "1000111111")
#: A passage counts from so many words of an item, and so large a share of equal ones.
MIN_WORDS, MIN_EQUAL = 13, 0.8
#: Items with fewer words are looked for whole.
SHORTEST = min(map(len, MASKS))
#: Pairs of places, or words compared, that are held at once.
HITS = 1 << 20
#: Leading bits of a seed that the bitmap tells apart (16 MB), and those of one of its pieces.
SEED_BITS, PIECE_BITS = 27, 16
SPANS = "array<struct<item_id:long,start:long,stop:long,share:double>>"


def seed_hashes(hashes: np.ndarray, mask: str) -> np.ndarray:
    """A hash of each place of a mask over a text's words."""
    n = len(hashes) - len(mask) + 1
    total = np.zeros(max(n, 0), np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1" and n > 0:
            total *= PRIME
            total += hashes[i : i + n]
    return total * PRIME


def seeds_of(hashes: np.ndarray, lengths: Iterable[int]) -> list[tuple[np.ndarray, int]]:
    """Seeds of a text for each mask, then for each length of short items that of all its
    words in a row; a seed's index is its place."""
    out = [mixed(seed_hashes(hashes, mask)) for mask in MASKS]
    return out + [mixed(gram_hashes(hashes, n) + np.uint64(n)) for n in lengths]


def places_by_seed(seeds: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each different seed with the places it has."""
    order = np.argsort(seeds, kind="stable")
    seeds, places = seeds[order], places[order]
    cuts = np.flatnonzero(seeds[1:] != seeds[:-1]) + 1
    return seeds[np.concatenate([[0], cuts])] if len(seeds) else seeds, np.split(places, cuts) if len(seeds) else []


def differences(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All different x - y, sorted. Many pairs (a text that repeats itself) are not
    listed: the differences are where the two sets of places correlate."""
    if len(x) * len(y) <= HITS:
        return np.unique(x[:, None] - y[None])
    n = int(x.max() + y.max() + 2)
    size = 1 << (n - 1).bit_length()
    own, other = np.zeros(size), np.zeros(size)
    own[x], other[y.max() - y] = 1, 1
    both = np.fft.irfft(np.fft.rfft(own) * np.fft.rfft(other), size)
    return np.flatnonzero(both[:n] > 0.5) - y.max()


def passages(text: np.ndarray, item: np.ndarray, shifts: np.ndarray) -> list[tuple[int, int, float]]:
    """First word, word after the last, share of equal words of each passage of an item,
    given the words' hashes and the shifts (place in the text less place in the item) to
    look at. Passages that overlap, as a text that repeats itself gives for every shift,
    are one, with the largest share."""
    found = []
    for shift in _promising(text, item, shifts).tolist():
        low, high = max(0, -shift), min(len(item), len(text) - shift)
        equal = text[low + shift : high + shift] == item[low:high]
        whole = len(item) < MIN_WORDS and len(equal) == len(item) and equal.all()
        start, stop, share = (0, len(item), 1.0) if whole else best_stretch(equal)
        if whole or stop > start and share >= MIN_EQUAL:
            found.append((start + low + shift, stop + low + shift, share))
    out: list[tuple[int, int, float]] = []
    for start, stop, share in sorted(found):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]), max(share, out[-1][2]))
        else:
            out.append((start, stop, share))
    return out


def _promising(text: np.ndarray, item: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The shifts with as many equal words as a passage, or a shorter item, has."""
    least = min(len(item), ceil(MIN_EQUAL * MIN_WORDS - 1e-9))
    low = np.maximum(0, -shifts)
    n = np.maximum(np.minimum(len(item), len(text) - shifts) - low, 0)
    shifts, low, n = shifts[n >= least], low[n >= least], n[n >= least]
    keep = []
    cuts = np.flatnonzero(np.diff(np.cumsum(n) // HITS)) + 1
    for part, x, m in zip(np.split(shifts, cuts), np.split(low, cuts), np.split(n, cuts), strict=True):
        if len(part):
            k = np.repeat(x - np.cumsum(m) + m, m) + np.arange(m.sum())
            sums = np.concatenate([[0], np.cumsum(text[k + np.repeat(part, m)] == item[k])])
            ends = np.cumsum(m)
            keep.append(part[sums[ends] - sums[ends - m] >= least])
    return np.concatenate(keep) if keep else shifts[:0]


def best_stretch(equal: np.ndarray, least: int = MIN_WORDS) -> tuple[int, int, float]:
    """Of all stretches of least words or more the one with the largest sum of
    1 - MIN_EQUAL per equal word and -MIN_EQUAL per other one.

    The sum is 0 or more just if the share is MIN_EQUAL or more, so if any stretch
    qualifies, this one does. Sums are whole numbers, so that a share of just
    MIN_EQUAL is not lost to rounding. With fewer words there is none: 0, 0, 0.
    """
    if len(equal) < least:
        return 0, 0, 0.0
    wanted = Fraction(MIN_EQUAL).limit_denominator(1000)
    gain, loss = wanted.denominator - wanted.numerator, wanted.numerator
    sums = np.concatenate([[0], np.cumsum(np.where(equal, gain, -loss))])
    lowest = np.minimum.accumulate(sums[: len(sums) - least])
    stop = int((sums[least:] - lowest).argmax()) + least
    start = int(sums[: stop - least + 1].argmin())
    return start, stop, float(equal[start:stop].mean())


def _item_words(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in slices(batches):
        words = [signed(word_hashes(words_of(t))) for t in part["text"]]
        yield pd.DataFrame({"item": part["item"], "item_id": part["item_id"], "words": pd.Series(words, index=part.index, dtype=object)})


def _item_seeds(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in slices(batches):
        rows = []
        for item, words in zip(part["item"], part["words"], strict=True):
            # Items shorter than any mask are one seed.
            seeds = seeds_of(words.view(np.uint64), [len(words)] if 0 < len(words) < SHORTEST else [])
            flat, at = np.concatenate(seeds), np.concatenate([np.arange(len(x)) for x in seeds])
            for seed, places in zip(*places_by_seed(flat, at), strict=True):
                rows.append((signed(seed[None])[0], item, places))
        yield pd.DataFrame(rows, columns=["seed", "item", "in_item"])


def _seed_bits(seeds: DataFrame) -> np.ndarray:
    """One bit for each leading SEED_BITS bits of a seed: at most 2**SEED_BITS / 8 bytes,
    whatever the benchmark. It comes in pieces that Spark builds."""
    place = F.shiftrightunsigned("seed", 64 - SEED_BITS)
    piece = F.shiftrightunsigned("place", PIECE_BITS).cast("int").alias("piece")

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << PIECE_BITS, np.uint8)
        bits[part["place"].to_numpy() & ((1 << PIECE_BITS) - 1)] = 1
        return pd.DataFrame({"piece": part["piece"][:1], "bits": [np.packbits(bits).tobytes()]})

    places = seeds.select(place.alias("place")).distinct().select("place", piece)
    out = np.zeros((1 << (SEED_BITS - PIECE_BITS), 1 << (PIECE_BITS - 3)), np.uint8)
    for r in places.groupBy("piece").applyInPandas(packed, "piece int, bits binary").toLocalIterator():
        out[r["piece"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def _hits(shared: Broadcast, lengths: list[int]) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The seeds of each text that the benchmark may have, with their places."""

    def hits(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = shared.value
        for part in slices(batches):
            rows = []
            for row, text in zip(part["row"], part["text"], strict=True):
                flat, at = [], []
                for seeds in seeds_of(word_hashes(words_of(text)), lengths):
                    place = seeds >> np.uint64(64 - SEED_BITS)
                    # Bits of a byte are packed from its highest.
                    hit = np.flatnonzero(bits[place >> np.uint64(3)] >> (np.uint8(7) - (place & np.uint64(7)).astype(np.uint8)) & 1)
                    flat.append(seeds[hit])
                    at.append(hit)
                seeds = np.concatenate(flat)
                if len(seeds):
                    for seed, places in zip(*places_by_seed(seeds, np.concatenate(at)), strict=True):
                        rows.append((signed(seed[None])[0], row, places))
            yield pd.DataFrame(rows, columns=["seed", "row", "in_text"])

    return hits


def _checked(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A text's words, then the items that may stand in it, one after another."""
    current, words = None, np.zeros(0, np.uint64)
    for batch in batches:
        out = []
        for row, asks, text, item_id, item, seeds in batch.itertuples(index=False, name=None):
            if not asks:
                current, words = row, word_hashes(words_of(text))
            elif row == current:
                shifts = np.unique(np.concatenate([differences(x["in_text"], x["in_item"]) for x in seeds]))
                out += [(row, item_id, *x) for x in passages(words, item.view(np.uint64), shifts)]
        if out:
            yield pd.DataFrame(out, columns=["row", "item_id", "start", "stop", "share"])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_hits, item_ids, max_share, contaminated, spans per row of docs.

    Masks ignore selected word positions, so passages with replaced words still hit:
    every passage holds all the words of a mask. Seeds of the benchmark and of the
    texts are tables, joined by hash. Around every hit document and item are compared word
    by word on that shift, and a stretch of MIN_WORDS words or more of which MIN_EQUAL
    agree is a passage; items shorter than that must stand there whole. Words are
    compared in lower case without punctuation. Passages of one item that overlap are one.

    Documents are read once, whatever the benchmark's size: a text's seeds that the
    benchmark cannot have are dropped by a bitmap of bounded size where they arise, so
    what is joined are hits. Of texts only those with hits move, once; the items to
    check come to them one after another. A seed in a third of the documents is a
    key that Spark splits. Nothing of the benchmark but the bitmap comes to the driver.

    Null and empty texts and items match nothing, repeated
    rows and null ids are kept, repeated items count once, an empty benchmark leaves
    all documents clean, other columns are ignored.
    """
    spark = docs.sparkSession
    given = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text").distinct()
    items = stored(
        given.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text").mapInPandas(
            _item_words, "item long, item_id long, words array<long>"
        ),
        "items",
    )
    seeds = stored(items.select("item", "words").mapInPandas(_item_seeds, "seed long, item long, in_item array<int>"), "seeds")
    short = items.select(F.size("words").alias("n")).where((F.col("n") > 0) & (F.col("n") < SHORTEST)).distinct()
    lengths = sorted(r["n"] for r in short.collect())
    bits = spark.sparkContext.broadcast(_seed_bits(seeds))
    texts = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text")
    hits = texts.mapInPandas(_hits(bits, lengths), "seed long, row long, in_text array<int>")
    # A repeated row has the same hits: once is enough.
    met = hits.join(seeds, "seed").dropDuplicates(["row", "item", "seed"])
    pairs = stored(met.groupBy("row", "item").agg(F.collect_list(F.struct("in_text", "in_item")).alias("seeds")), "pairs")
    asking = pairs.join(items, "item").select("row", F.lit(True).alias("asks"), F.lit(None).cast("string").alias("text"), "item_id", "words", "seeds")
    asked = texts.join(pairs.select("row").distinct(), "row", "left_semi").dropDuplicates(["row"])
    empty = [F.lit(None).cast(asking.schema[c].dataType).alias(c) for c in ("item_id", "words", "seeds")]
    both = asked.select("row", F.lit(False).alias("asks"), "text", *empty).union(asking)
    found = both.repartition("row").sortWithinPartitions("row", "asks").mapInPandas(
        _checked, "row long, item_id long, start long, stop long, share double"
    )
    held = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("item_id", "start", "stop", "share"))).alias("spans"))
    spans = F.coalesce("spans", F.array().cast(SPANS))
    out = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row")).join(held, "row", "left")
    return out.select("doc_id", spans.alias("spans")).select(
        "doc_id",
        F.size("spans").cast("long").alias("n_hits"),
        F.array_sort(F.array_distinct(F.transform("spans", lambda x: x["item_id"]))).alias("item_ids"),
        F.coalesce(F.array_max(F.transform("spans", lambda x: x["share"])), F.lit(0.0)).alias("max_share"),
        (F.size("spans") > 0).alias("contaminated"),
        "spans",
    )
