"""Token counts of byte-level BPE by rank-synchronous merging of arrays."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import cache, cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from daybook.llm.common import per_document, slices, utf8

# Fixed value: the pre-token pattern of this kind of vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
_NONE = np.int64(1) << 40
#: From so many bytes on a piece is merged by a queue: rounds over all of it would be too many.
LONG = 2048


def byte_symbols() -> dict[int, str]:
    """The printable character that vocabulary files write for each byte: itself if
    printable in Latin-1, else the next free one from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class Merges:
    """A vocabulary's merges as sorted arrays: pair of symbols, its rank, its result."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        key = np.array([(ids[a] << 32) | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(key)
        self.pairs = key[order]
        self.ranks = order.astype(np.int64)
        self.results = np.array([ids[a + b] for a, b in pairs], np.int64)[order]
        self.bytes = np.array([ids[s] for _, s in sorted(byte_symbols().items())], np.int64)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair of neighbours; _NONE where they do not merge."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        hit = self.pairs[at] == key
        return np.where(hit, self.ranks[at], _NONE), self.results[at]

    def lengths(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left of each piece after all merges.

        All pieces lie in one array. In each round every piece finds its own pair of
        lowest rank and merges all places of it, from the left. Finished pieces leave. Pieces over LONG bytes,
        which would take as many rounds as they have different pairs, wait in a queue.
        """
        out = np.array([len(p) for p in pieces], np.int64)
        for i in np.flatnonzero(out > LONG):
            out[i] = self.queued(pieces[i])
        active = np.flatnonzero((out > 1) & (np.array([len(p) for p in pieces]) <= LONG))
        symbols = self.bytes[np.frombuffer(b"".join(pieces[i] for i in active), np.uint8)]
        owner = np.repeat(np.arange(len(active)), out[active])
        sizes = out[active].copy()
        while len(symbols) > 1:
            inside = owner[1:] == owner[:-1]
            rank, result = self.lookup(symbols[:-1], symbols[1:])
            rank = np.where(inside, rank, _NONE)
            starts = np.flatnonzero(np.concatenate([[True], ~inside]))
            lowest = np.minimum.reduceat(np.append(rank, _NONE), starts)
            places = owner[starts]
            best = np.full(len(active), _NONE)
            best[places] = lowest
            take = (rank < _NONE) & (rank == best[owner[:-1]])
            # Of places that overlap (a pair of one symbol in a run) every second merges.
            hits = np.flatnonzero(take)
            run = np.concatenate([[True], np.diff(hits) > 1]) if len(hits) else np.zeros(0, bool)
            begin = hits[run][np.cumsum(run) - 1] if len(hits) else hits
            hits = hits[(hits - begin) % 2 == 0]
            symbols[hits] = result[hits]
            sizes -= np.bincount(owner[hits], minlength=len(active))
            stay = best[owner] < _NONE
            stay[hits + 1] = False
            symbols, owner = symbols[stay], owner[stay]
        out[active] = sizes
        return out

    def queued(self, piece: bytes) -> int:
        """Symbols left of a long piece: its pairs wait by rank, then place."""
        symbols = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        after = [*range(1, len(symbols)), -1]
        before = [-1, *range(len(symbols) - 1)]
        ranks, results = self.lookup(np.array(symbols[:-1]), np.array(symbols[1:]))
        # rank, place, both symbols: a pair that has changed since is passed over.
        waiting = [(int(ranks[i]), int(i), symbols[i], symbols[i + 1], int(results[i])) for i in np.flatnonzero(ranks < _NONE)]
        heapify(waiting)
        left = len(symbols)

        def wait(i: int, j: int) -> None:
            pair = (symbols[i] << 32) | symbols[j]
            if pair in self.table:
                rank, result = self.table[pair]
                heappush(waiting, (rank, i, symbols[i], symbols[j], result))

        while waiting:
            _, i, x, y, result = heappop(waiting)
            j = after[i]
            if symbols[i] != x or j < 0 or symbols[j] != y:
                continue
            symbols[i], symbols[j] = result, -1
            after[i] = after[j]
            left -= 1
            if after[i] >= 0:
                before[after[i]] = i
                wait(i, after[i])
            if before[i] >= 0:
                wait(before[i], i)
        return left

    @cached_property
    def table(self) -> dict[int, tuple[int, int]]:
        """Rank and result by pair; made when the first long piece comes."""
        return dict(zip(self.pairs.tolist(), zip(self.ranks.tolist(), self.results.tolist(), strict=True), strict=True))

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        split: list[list[str]] = []
        extra = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = [text]
            if self.special is not None and self.special.search(text):
                parts = self.special.split(text)
                extra[i] = len(parts) - 1
            split.append([p for part in parts for p in self.pattern.findall(part)])
        new = list({p for pieces in split for p in pieces if p not in self.known})
        if len(self.known) + len(new) > 400_000:
            self.known.clear()
            new = list({p for pieces in split for p in pieces})
        self.known.update(zip(new, self.lengths(list(map(utf8, new))).tolist(), strict=True))
        known = self.known.__getitem__
        return extra + np.array([sum(map(known, pieces)) for pieces in split], np.int64)


@cache
def _merges(name: str) -> Merges:
    return Merges(SparkFiles.get(name))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row of docs.

    vocabulary: path of a byte-level BPE file on the driver; Spark hands it to the
    executors. Null and empty texts have no tokens; over_limit is n_tokens > limit.
    Texts are counted whole. Special strings count as one token. The pre-tokens a
    task remembers are bounded. Repeated rows and null ids are kept; other columns
    are ignored.
    """
    docs.sparkSession.sparkContext.addFile(vocabulary)
    name = vocabulary.rsplit("/", 1)[-1]

    def counts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merges = _merges(name)
        for part in slices(batches):
            texts = [x or "" for x in part["text"]]
            n = merges.count(texts)
            yield pd.DataFrame(
                {"doc_id": part["doc_id"].to_numpy(), "n_bytes": [len(utf8(x)) for x in texts], "n_tokens": n, "over_limit": n > limit}
            )

    return per_document(docs, counts, "n_bytes long, n_tokens long, over_limit boolean")
