"""Benchmark decontamination by spaced seeds.

A seed is a mask over neighbouring words; words under a 0 are ignored, so a
changed word there does not hide a match. Each mask's hashes of all word
positions of all documents are looked up among those of the benchmark items;
every hit fixes a diagonal (document position minus item position), along
which document and item are compared word by word.

A document is contaminated by an item of n words if

* on one diagonal, or in order within n / 8 words around it (words lost or put
  in), at least ``COVERAGE`` of the item's words match, and at least
  ``MIN_WORDS`` of them; or
* a stretch of at least ``RUN`` item words matches on a diagonal to that share,
  and to ``RUN_WORDS`` words at least (a stock phrase and a few words that
  match by chance are no leak, however often the phrase comes).

Every word of the document counts once, and only where it stands in the item's
order. Items of fewer than ``SHORT`` words are looked up by every run of words
that must be left whole when a quarter of them is changed, so none is missed.

The benchmark is the stated query set: its items are dealt into blocks of about
``BLOCK_WORDS`` words by a hash, each block's words are sent to the tasks, which
index them once a worker, and all documents pass each block. Documents stay
where they are: no shuffle. Hits are compared in pieces of ``PIECE_WORDS``, so a
seed that all items share costs time in proportion to its hits, not memory.

Defined results
    null or empty text     matches nothing
    item of fewer words    than ``MIN_WORDS``: too common to prove a leak, ignored
    ties, repeated items   each item id has rows of its own
    repeated documents     each row is judged alone
    very long texts        whole, hashed in pieces
    empty table            empty result
    extra columns          ignored by ``leaks``, kept by ``decontaminated``
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievekit.llm.common import SPACE, prepare_python, without_ids
from sievekit.llm.tokens import each_word_hashes, mixed

MASKS = ("11111", "1101011", "11010011", "101100101")
SHORT = 15  # items of fewer words are looked up by runs of words
MIN_WORDS = 5
COVERAGE = 0.75
RUN, RUN_WORDS = 13, 13
BLOCK_WORDS = 1_000_000
PIECE_WORDS = 2_000_000  # word pairs compared at once
_ODD = 0xD6E8FEB86659FD93


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """The mask's hash at each position where it fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k, use in enumerate(mask):
        if use == "1":
            total *= np.uint64(_ODD)
            total += words[k : k + n]
    return mixed(total + np.uint64(int(mask, 2)))


def needed(n: int, coverage: float = COVERAGE) -> int:
    """Words of an item of n words that must match."""
    return max(MIN_WORDS, math.ceil(coverage * n - 1e-9))


def whole_run(n: int, coverage: float = COVERAGE) -> int:
    """Length of a run of words that is left whole somewhere in an item of n
    words when as many as may be are changed."""
    return n // (n - needed(n, coverage) + 1)


def item_words(items: list[tuple[int, str]]) -> list[tuple[int, np.ndarray]]:
    """Word hashes of the items that are long enough."""
    texts = [t.encode("utf-8", "surrogatepass") for _, t in items]
    return [(i, w) for (i, _), w in zip(items, each_word_hashes(texts), strict=True) if len(w) >= MIN_WORDS]


class Index:
    """Seeds of a block of items, and the items' words."""

    def __init__(self, items: list[tuple[int, np.ndarray]], coverage: float = COVERAGE):
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]
        self.lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.flat = np.concatenate(self.words) if items else np.empty(0, dtype=np.uint64)
        self.need = np.array([needed(int(n), coverage) for n in self.lengths], dtype=np.int64)
        runs = {int(n): "1" * min(whole_run(int(n), coverage), MIN_WORDS) for n in np.unique(self.lengths) if n < SHORT}
        plan: dict[str, list[int]] = {}
        for k, n in enumerate(self.lengths.tolist()):
            for mask in [runs[n]] if n < SHORT else MASKS:
                plan.setdefault(mask, []).append(k)
        self.seeds = []
        for mask, chosen in plan.items():
            each = [seed_hashes(self.words[k], mask) for k in chosen]
            flat = np.concatenate(each)
            owner = np.repeat(np.array(chosen, dtype=np.int64), [len(x) for x in each])
            place = np.concatenate([np.arange(len(x)) for x in each])
            order = np.argsort(flat, kind="stable")
            flat, owner, place = flat[order], owner[order], place[order]
            bits = max(10, min(26, int(len(flat)).bit_length() + 6))
            seen = np.zeros(1 << bits, dtype=bool)
            seen[(flat >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.seeds.append((mask, flat, owner, place, seen, np.uint64(64 - bits)))

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, diagonal) of all hits, each once, ordered."""
        found = []
        for mask, flat, owner, place, seen, shift in self.seeds:
            h = seed_hashes(words, mask)
            if not len(h):
                continue
            at = np.flatnonzero(seen[(h >> shift).astype(np.int64)])
            low, high = np.searchsorted(flat, h[at], "left"), np.searchsorted(flat, h[at], "right")
            many = high - low
            if many.sum():
                entry = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
                found.append(np.stack([owner[entry], np.repeat(at, many) - place[entry]], axis=1))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        both = np.unique(np.concatenate(found), axis=0)
        return both[:, 0], both[:, 1]


_indexes: dict[str, Index] = {}


def index_of(key: str, items: list[tuple[int, np.ndarray]], coverage: float) -> Index:
    """The index of a block, made once in a worker; one block is held."""
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = Index(items, coverage)
    return _indexes[key]


def longest_stretch(same: np.ndarray, share: float) -> int:
    """Length of the longest stretch that begins and ends with a match and of
    which at least ``share`` matches."""
    gain = np.concatenate(([0.0], np.cumsum(np.where(same, 1 - share, -share))))
    best, falls = 0, []
    for i, g in enumerate(gain):
        if not falls or g < gain[falls[-1]]:
            falls.append(i)
    j = len(gain) - 1
    while falls and j >= 0:
        while falls and gain[j] >= gain[falls[-1]] - 1e-9:
            best = max(best, j - falls.pop())
        j -= 1
    return best


def common_in_order(item: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over the item."""
    places: dict[int, int] = {}
    for k, w in enumerate(item.tolist()):
        places[w] = places.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    row = full
    for w in words.tolist():
        if (at := places.get(w)) is not None:
            hit = row & at
            row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


def leaked_run(same: np.ndarray, share: float, run: int) -> int:
    """Longest stretch that proves a leak by itself; 0 if none does."""
    longest = longest_stretch(same, share)
    if longest * share >= RUN_WORDS:
        return longest if longest >= run else 0
    sums = np.concatenate([[0], np.cumsum(same)])
    for n in range(longest, run - 1, -1):
        if (sums[n:] - sums[: len(sums) - n] >= RUN_WORDS).any():
            return n
    return 0


def _matches(words: np.ndarray, index: Index, item: np.ndarray, diagonal: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(item, diagonal, which words match) of each hit, compared in pieces."""
    size = index.lengths[item]
    pieces = np.concatenate([[0], np.cumsum(size)]) // PIECE_WORDS
    for k in np.unique(pieces[:-1]):
        own = np.flatnonzero(pieces[:-1] == k)
        ends = np.cumsum(size[own])
        begin = ends - size[own]
        step = np.arange(ends[-1]) - np.repeat(begin, size[own])
        at = np.repeat(diagonal[own], size[own]) + step
        inside = (at >= 0) & (at < len(words))
        same = np.zeros(len(at), dtype=bool)
        same[inside] = words[at[inside]] == index.flat[(np.repeat(index.starts[item[own]], size[own]) + step)[inside]]
        count = np.add.reduceat(same, begin)
        # fewer than a quarter on the best diagonal are no leak, whatever was lost or put in
        worth = np.flatnonzero(count >= np.maximum(MIN_WORDS, np.minimum(size[own] // 4, RUN_WORDS)))
        for w in worth:
            yield int(item[own[w]]), int(diagonal[own[w]]), same[begin[w] : ends[w]]


def _overlaps(words: np.ndarray, index: Index, coverage: float, run: int) -> Iterator[tuple[int, int, int, float, int]]:
    """(item, matched, stretch, coverage, first word) of contaminating items."""
    best: dict[int, tuple[int, int, int]] = {}
    for item, diagonal, same in _matches(words, index, *index.hits(words)):
        n, matched = len(same), int(same.sum())
        stretch = leaked_run(same, coverage, run) if n >= run else 0
        near = n // 8
        if matched < index.need[item] and near and matched >= max(MIN_WORDS, n // 4):
            lo, hi = max(0, diagonal - near), min(len(words), diagonal + n + near)
            matched = max(matched, common_in_order(index.words[item], words[lo:hi]))
        if matched >= index.need[item] or stretch:
            best[item] = max(best.get(item, (0, 0, 0)), (matched, max(stretch, longest_stretch(same, coverage)), -max(diagonal, 0)))
    for item in sorted(best):
        matched, stretch, first = best[item]
        yield item, matched, stretch, matched / len(index.words[item]), -first


def _judge(key: str, items: list[tuple[int, np.ndarray]], coverage: float, run: int):
    names = ["_id", "item_id", "matched_words", "item_words", "longest_stretch", "coverage", "first_word"]
    kinds = [pa.int64()] * 5 + [pa.float64(), pa.int64()]

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_of(key, items, coverage)
        for b in batches:
            rows = []
            texts = b.column("_text").cast(pa.binary()).to_pylist()
            for doc, words in zip(b.column("_id").to_pylist(), each_word_hashes(texts), strict=True):
                for item, matched, stretch, share, first in _overlaps(words, index, coverage, run):
                    rows.append((doc, index.ids[item], matched, len(index.words[item]), stretch, share, first))
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return each


def leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", coverage: float = COVERAGE, run: int = RUN,
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per contaminated document and item: id, item_id, matched_words,
    item_words, longest_stretch, coverage, first_word."""
    prepare_python(df.sparkSession)
    schema = "_id long, item_id long, matched_words long, item_words long, longest_stretch long, coverage double, first_word long"
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("words")).filter(
        "item is not null and words is not null")
    total = items.agg(F.sum(F.size(F.split("words", SPACE)))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))
    docs = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    out = df.sparkSession.createDataFrame([], schema)
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k) if blocks > 1 else items
        own = item_words(sorted((r["item"], r["words"]) for r in block.collect()))
        if own:
            out = out.unionByName(docs.mapInArrow(_judge(uuid.uuid4().hex, own, coverage, run), schema))
    return out.withColumnRenamed("_id", id_col)


def decontaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``df`` without its contaminated documents."""
    return without_ids(df, id_col, leaks(df, benchmark, id_col, **options).select(id_col), "leaks")
