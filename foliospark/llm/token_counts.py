"""Token counts by merging whole arrays of pre-tokens, one rank of each sequence at a time.

The pre-tokens of a batch that are new to a worker lie in one flat symbol array with a sequence number
beside each symbol. A round looks up the rank of every adjacent pair, takes each sequence's lowest, merges
all its places in all sequences at once (in runs of one symbol every second place, from the left), and puts
sequences without a mergeable pair aside. The symbols that survive are the tokens.

A very long pre-token would need a pass over all of it for each rank. Its pairs lie in buckets by rank instead: the
lowest bucket is merged at all its places at once, and only the pairs beside them are looked up again. A pair that uses
a new symbol ranks behind the pair that made it, so the ranks come up in the same order.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm import pretokens, shared

REMEMBERED = 400_000
# Symbols merged together; longer batches of new pre-tokens are cut between pre-tokens.
SYMBOLS = 1 << 20
# Bytes beyond which a pre-token is merged by buckets.
LONG = 4096


class Ranks:
    """The merges as sorted numbers ``left * n + right`` with their ranks and results."""

    def __init__(self, vocabulary: pretokens.Vocabulary):
        ids = vocabulary.ids
        self.n = len(ids)
        pairs = np.array([ids[u] * self.n + ids[v] for u, v in vocabulary.merges], np.int64)
        made = np.array([ids[u + v] for u, v in vocabulary.merges], np.int32)
        self.rank = np.argsort(pairs, kind="stable").astype(np.int32)
        self.pairs, self.made = pairs[self.rank], made
        characters = pretokens.byte_characters()
        self.inner = np.array([ids[c] for c in characters], np.int32)
        self.final = np.array([ids[c + vocabulary.suffix] for c in characters], np.int32)
        self.splitter, self.specials = vocabulary.splitter(), frozenset(vocabulary.specials)


def merge(words: list[bytes], ranks: Ranks) -> np.ndarray:
    """Number of tokens of each (non-empty) pre-token."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(lengths)
    ids = ranks.inner[data].copy()
    ids[ends - 1] = ranks.final[data[ends - 1]]
    sequence = np.repeat(np.arange(len(words)), lengths)
    counts = np.zeros(len(words), np.int64)
    none = np.int32(len(ranks.made))
    while len(ids):
        same = np.zeros(len(ids), bool)
        same[:-1] = sequence[1:] == sequence[:-1]
        places = np.flatnonzero(same)
        wanted = ids[places].astype(np.int64) * ranks.n + ids[places + 1]
        found = np.searchsorted(ranks.pairs, wanted)
        found[found == len(ranks.pairs)] = 0
        rank = np.full(len(ids), none, np.int32)
        if len(ranks.pairs):
            rank[places] = np.where(ranks.pairs[found] == wanted, ranks.rank[found], none)
        starts = np.flatnonzero(np.concatenate(([True], sequence[1:] != sequence[:-1])))
        lowest = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.append(starts, len(ids)))
        done = lowest == none
        if done.any():
            counts[sequence[starts[done]]] = sizes[done]
            keep = ~np.repeat(done, sizes)
            ids, sequence, rank = ids[keep], sequence[keep], rank[keep]
            lowest, sizes = lowest[~done], sizes[~done]
            if not len(ids):
                break
        hit = rank == np.repeat(lowest, sizes)
        hit = _every_second(hit)
        at = np.flatnonzero(hit)
        ids[at] = ranks.made[rank[at]]
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        ids, sequence = ids[keep], sequence[keep]
    return counts


def merge_long(word: bytes, ranks: Ranks) -> int:
    """Number of tokens of one pre-token of any length."""
    data = np.frombuffer(word, np.uint8)
    n, none = len(data), np.int32(len(ranks.made))
    ids = ranks.inner[data].copy()
    ids[-1] = ranks.final[data[-1]]
    following, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    rank = np.full(n, none, np.int32)                    # of the pair that begins at each place
    buckets: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []

    def look_up(places: np.ndarray) -> None:
        rank[places] = none
        paired = places[following[places] < n]
        wanted = ids[paired].astype(np.int64) * ranks.n + ids[following[paired]]
        found = np.minimum(np.searchsorted(ranks.pairs, wanted), len(ranks.pairs) - 1)
        known = ranks.pairs[found] == wanted
        paired, now = paired[known], ranks.rank[found[known]]
        rank[paired] = now
        order = np.argsort(now, kind="stable")
        paired, now = paired[order], now[order]
        cuts = np.flatnonzero(np.diff(now)) + 1
        for part in np.split(paired, cuts) if len(now) else ():
            number = int(rank[part[0]])
            if number not in buckets:
                buckets[number] = []
                heappush(waiting, number)
            buckets[number].append(part)

    if len(ranks.pairs):
        look_up(np.arange(n))
    left = n
    while waiting:
        number = heappop(waiting)
        places = np.unique(np.concatenate(buckets.pop(number)))
        places = places[rank[places] == number]
        if len(places) > 1:                              # pairs of one symbol may overlap
            first = np.concatenate(([True], following[places[:-1]] != places[1:]))
            start = np.maximum.accumulate(np.where(first, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - start) % 2 == 0]
        if not len(places):
            continue
        gone = following[places]
        ids[places] = ranks.made[number]
        following[places] = following[gone]
        rank[gone] = none
        inner = following[places] < n
        before[following[places[inner]]] = places[inner]
        left -= len(places)
        beside = before[places]
        look_up(np.unique(np.concatenate((places, beside[beside >= 0]))))
    return left


def _every_second(hit: np.ndarray) -> np.ndarray:
    """Of each run of hits (only a pair of equal symbols makes one) the first, third and so on."""
    at = np.flatnonzero(hit)
    if len(at) > 1:
        first = np.concatenate(([True], np.diff(at) != 1))
        start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        out = np.zeros_like(hit)
        out[at[(np.arange(len(at)) - start) % 2 == 0]] = True
        return out
    return hit


class Counter:
    def __init__(self, ranks: Ranks):
        self.ranks, self.known = ranks, dict.fromkeys(ranks.specials, 1)

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > REMEMBERED:
            self.known = dict.fromkeys(self.ranks.specials, 1)
        new = sorted((w for w in words if w not in self.known), key=len)
        at = 0
        while at < len(new):
            end, size = at, 0
            while end < len(new) and (end == at or size < SYMBOLS and len(new[end]) * 4 <= LONG):    # long ones alone
                size += len(new[end])
                end += 1
            part = new[at:end]
            words = [w.encode() for w in part]
            counts = [merge_long(words[0], self.ranks)] if len(words[0]) > LONG else merge(words, self.ranks).tolist()
            self.known.update(zip(part, counts, strict=True))
            at = end

    def counts(self, texts: list[str | None]) -> list[int]:
        split = [self.ranks.splitter.words(t) for t in texts]
        self.learn(set().union(*split))
        known = self.known
        return [sum(map(known.__getitem__, words)) for words in split]


def count(docs: DataFrame, path: str, limit: int = 2048, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    A null or empty text has 0 bytes and tokens. Repeated rows are counted each, an empty table gives an
    empty one, other columns are not read. Texts are taken in slices of a batch, so that memory follows the
    longest text and not the batch. One narrow stage, no shuffle; the broadcast holds the merges only.
    """
    spark = docs.sparkSession
    shared.bytes_per_batch(spark)
    table = spark.sparkContext.broadcast(Ranks(pretokens.read(path)))

    def run(batches):
        counter = shared.worker_state(Counter, table.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).to_pylist()
                tokens = counter.counts(texts)
                sizes = [0 if t is None else len(t) if t.isascii() else len(t.encode()) for t in texts]
                yield pa.record_batch([part.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                                       pa.array([n > limit for n in tokens], pa.bool_())],
                                      ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    selected = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = selected.schema["doc_id"].dataType.simpleString()
    return selected.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


