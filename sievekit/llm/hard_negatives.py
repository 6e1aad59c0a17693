"""Hard negatives by an inverted multi-index with certified stops.

Index: vectors are cut into two halves, each half gets the nearest word of its
codebook (k-means over at most ``SAMPLE`` rows), and the two words name a cell.
Every vector is indexed: rows are written in the order of the cells, cells in
parts of about ``BLOCK`` rows, so one that holds a third of all rows is many
tasks' work.

Search: a half's words are ordered by the most that any vector of the word can
add to the score (score of the word plus norm times radius). A heap walks the
pairs of words in the order of the summed bounds (multi-sequence), and stops as
soon as the next bound is below the worst row that is still held: nothing
unseen can then enter, and the window is certified. Results are exact.

Shape: queries are the stated set (ids divisible by ``EVERY``), handled in
blocks of at most ``QUERY_BYTES``, which are broadcast; every task walks its
own rows of the index for all of them and returns its few best rows, which
are ranked per query. One pass finds the positives, one the negatives. Rows of
the codebook sample give first lower bounds, so most cells are never opened
where the vectors have structure.

Defined results
    null vec_id, label or vector, null or non-finite component: no part
    vectors of other lengths   missing components count as 0
    components beyond a long   the largest or smallest long
    repeated vec_id            every row is a candidate; as a query, the row
                               with the smallest label, then vector, is used;
                               no row with the query's id is its positive or negative
    ties                       smaller vec_id first, then smaller label
    positive score <= 0        no negatives, but for score 0 itself
    empty table                empty result
    extra columns              ignored
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievekit.llm.common import prepare_python, stage

EVERY = 50  # ids divisible by this are queries
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
SAMPLE = 20_000  # rows that the codebooks are fitted on, at most
CELL_ROWS = 1_000  # rows that a cell should have; gives the number of words, at most MAX_WORDS
MAX_WORDS = 64
ROUNDS = 8  # of k-means
BLOCK = 1_024  # rows of a part of a cell, about
PIECE_ROWS = 8_192  # rows of the index that a task searches at once
QUERY_BYTES = 32 << 20  # vectors of a block of queries
EXACT = 2.0**52  # sums below it are exact in a double
LONG = np.iinfo(np.int64)


# ---------------------------------------------------------------- rows

def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that take part, as whole numbers in bytes."""
    for b in batches:
        ids, labels, vectors = [], [], []
        for i, label, v in zip(b.column("vec_id").to_pylist(), b.column("label").to_pylist(), b.column("vector"), strict=True):
            if i is None or label is None or not v.is_valid or v.values.null_count:
                continue
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(x).all():
                continue
            with np.errstate(over="ignore"):
                x = np.floor(x * SCALE)
            whole = np.where(x >= 2.0**63, LONG.max, np.where(x < -(2.0**63), LONG.min, np.clip(x, -(2.0**62), 2.0**62).astype(np.int64)))
            big = np.abs(x) >= 2.0**62
            whole[big & (np.abs(x) < 2.0**63)] = x[big & (np.abs(x) < 2.0**63)].astype(np.int64)
            ids.append(i)
            labels.append(label)
            vectors.append(whole.astype("<i8").tobytes())
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(vectors, pa.binary())],
                              names=["vec_id", "label", "v"])


def whole_rows(embeddings: DataFrame, shift_labels: bool = True) -> DataFrame:
    """(vec_id, label, v): the rows that take part; v holds 64-bit numbers."""
    label = F.col("label").cast("long")
    if shift_labels:
        label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"),
                             F.col("embedding").alias("vector")).mapInArrow(_rows, "vec_id long, label long, v binary")


def matrix(vectors: list[bytes], dim: int) -> np.ndarray:
    """Vectors of bytes as rows of ``dim`` numbers, filled up with 0."""
    if all(len(v) == 8 * dim for v in vectors):
        return np.frombuffer(b"".join(vectors), dtype="<i8").reshape(len(vectors), dim)
    out = np.zeros((len(vectors), dim), dtype=np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v) // 8] = np.frombuffer(v, dtype="<i8")
    return out


@dataclass
class Scorer:
    """Exact inner products: in doubles where they cannot round, else in whole numbers."""

    rows: np.ndarray

    def __post_init__(self) -> None:
        self.real = self.rows.astype(np.float64)
        self.norm = float(np.sqrt((self.real**2).sum(axis=1).max())) if len(self.rows) else 0.0

    def scores(self, q: np.ndarray, at: slice = slice(None)) -> np.ndarray:
        real = q.astype(np.float64)
        if self.norm * float(np.sqrt(real @ real)) < EXACT:
            return (self.real[at] @ real).astype(np.int64)
        weights = [int(x) for x in q]
        return np.array([max(LONG.min, min(LONG.max, sum(int(a) * w for a, w in zip(row, weights, strict=True))))
                         for row in self.rows[at]], dtype=np.int64)


# ---------------------------------------------------------------- codebooks and index

def codebook(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k-means words of the points (rows), starting from rows spread over them."""
    if not len(points):
        return np.zeros((1, points.shape[1]))
    distinct = np.unique(points, axis=0)
    words = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)].astype(np.float64)
    for _ in range(rounds):
        near = nearest(points, words)
        counts = np.bincount(near, minlength=len(words))
        for w in np.flatnonzero(counts):
            words[w] = points[near == w].mean(axis=0)
    return words


def nearest(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (points @ words.T * -2 + (words**2).sum(axis=1)).argmin(axis=1)


@dataclass
class Codebooks:
    left: np.ndarray
    right: np.ndarray

    @property
    def half(self) -> int:
        return self.left.shape[1]

    @property
    def dim(self) -> int:
        return self.left.shape[1] + self.right.shape[1]


def fit_codebooks(sample: np.ndarray, n_rows: int) -> Codebooks:
    k = max(1, min(MAX_WORDS, round((n_rows / CELL_ROWS) ** 0.5)))
    half = sample.shape[1] // 2
    real = sample.astype(np.float64)
    return Codebooks(codebook(real[:, :half], k), codebook(real[:, half:], k))


def _cells(books: Codebooks) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("v").to_pylist(), books.dim).astype(np.float64).reshape(b.num_rows, books.dim)
            a, z = nearest(x[:, : books.half], books.left), nearest(x[:, books.half :], books.right)
            yield pa.record_batch([*b.columns, pa.array((a * len(books.right) + z).astype(np.int32))], names=[*b.schema.names, "cell"])

    return run


def build_index(rows: DataFrame, books: Codebooks) -> DataFrame:
    """The index of staged ``whole_rows``: every row with its cell, neighbours in
    the order of the cells; cells of many rows are cut into parts."""
    celled = stage(rows.mapInArrow(_cells(books), "vec_id long, label long, v binary, cell int"), "negatives-cells")
    counts = celled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))  # at most MAX_WORDS ** 2 rows
    parted = celled.join(F.broadcast(counts), "cell").withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")).cast("int"))
    return stage(parted.repartitionByRange("cell", "part").sortWithinPartitions("cell", "part").select("cell", "vec_id", "label", "v"),
                 "negatives-index")


# ---------------------------------------------------------------- search

class Piece:
    """Some rows of the index, ready for searching: per cell its ids, labels and
    vectors in the order of the labels, and per word the largest radius."""

    def __init__(self, books: Codebooks, cell: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        order = np.lexsort((ids, labels, cell))
        cell, ids, labels, rows = cell[order], ids[order], labels[order], rows[order]
        real = rows.astype(np.float64)
        self.half = books.half
        self.cells: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, Scorer]] = {}
        radius: tuple[dict[int, float], dict[int, float]] = ({}, {})
        cuts = np.flatnonzero(np.diff(cell, prepend=-1))
        for start, end in zip(cuts, [*cuts[1:], len(cell)], strict=True):
            pair = divmod(int(cell[start]), len(books.right))
            self.cells[pair] = (ids[start:end], labels[start:end], Scorer(rows[start:end]))
            halves = (real[start:end, : self.half], books.left[pair[0]]), (real[start:end, self.half :], books.right[pair[1]])
            for known, word, (part, centre) in zip(radius, pair, halves, strict=True):
                known[word] = max(known.get(word, 0.0), float(np.sqrt(((part - centre) ** 2).sum(axis=1).max())))
        self.words = [sorted(r) for r in radius]
        self.radius = [np.array([r[w] for w in words]) for r, words in zip(radius, self.words, strict=True)]
        self.centres = [book[words] for book, words in zip((books.left, books.right), self.words, strict=True)]

    def bounds(self, q: np.ndarray) -> list[np.ndarray]:
        """For each half: the most that a vector of a word adds, with room for rounding."""
        out = []
        for part, centres, radius in zip((q[: self.half], q[self.half :]), self.centres, self.radius, strict=True):
            norm = float(np.sqrt(part @ part))
            size = norm * (np.sqrt((centres**2).sum(axis=1)) + radius)
            out.append(centres @ part + norm * radius + 1e-9 * size + 1e-6)
        return out

    def walk(self, q: np.ndarray) -> Iterator[tuple[float, tuple[np.ndarray, np.ndarray, Scorer]]]:
        """(bound, cell) of the cells, highest bound first: the multi-sequence heap."""
        left, right = self.bounds(q.astype(np.float64))
        a, z = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
        heap = [(-(left[a[0]] + right[z[0]]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if j + 1 < len(z):
                heapq.heappush(heap, (-(left[a[i]] + right[z[j + 1]]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(left[a[i + 1]] + right[z[0]]), i + 1, 0))
            found = self.cells.get((self.words[0][a[i]], self.words[1][z[j]]))
            if found is not None:
                yield -bound, found


class Best:
    """The first ``k`` rows by (score down, id, label), none below ``floor``."""

    __slots__ = ("k", "floor", "rows")

    def __init__(self, k: int, floor: int):
        self.k, self.floor, self.rows = k, floor, []

    def add(self, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        if len(scores) > 4 * self.k:
            keep = np.lexsort((labels, ids, -scores))[: self.k]
            scores, ids, labels = scores[keep], ids[keep], labels[keep]
        rows = self.rows + [(-int(s), int(i), int(y)) for s, i, y in zip(scores, ids, labels, strict=True)]
        rows.sort()
        self.rows = rows[: self.k]
        if len(self.rows) == self.k:
            self.floor = max(self.floor, -self.rows[-1][0])


@dataclass
class Queries:
    """A block of queries. ``wanted[i]`` holds (positive, its score, lowest and
    highest score of a negative, floor) and is empty when positives are sought."""

    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    floor: np.ndarray
    wanted: list[list[tuple[int, int, int, int, int]]]


def _search(books: Codebooks, queries: Queries, negatives: bool) -> Callable:
    def positives_of(piece: Piece, i: int, best: list[Best]) -> None:
        q, label, me, mine = queries.rows[i], queries.labels[i], queries.ids[i], best[0]
        for bound, (ids, labels, scorer) in piece.walk(q):
            if bound < mine.floor:
                break
            span = slice(int(np.searchsorted(labels, label)), int(np.searchsorted(labels, label, side="right")))
            if span.start == span.stop:
                continue
            scores = scorer.scores(q, span)
            hit = np.flatnonzero((scores >= mine.floor) & (ids[span] != me))
            if len(hit):
                mine.add(scores[hit], ids[span][hit], labels[span][hit])

    def negatives_of(piece: Piece, i: int, best: list[Best]) -> None:
        q, label, me, wanted = queries.rows[i], queries.labels[i], queries.ids[i], queries.wanted[i]
        if not wanted:
            return
        for bound, (ids, labels, scorer) in piece.walk(q):
            floor = min(b.floor for b in best)
            if bound < floor:
                break
            scores = scorer.scores(q)
            hit = np.flatnonzero((scores >= floor) & (labels != label) & (ids != me))
            if not len(hit):
                continue
            scores, near, other = scores[hit], ids[hit], labels[hit]
            for mine, (_, _, _, high, _) in zip(best, wanted, strict=True):
                fits = np.flatnonzero((scores >= mine.floor) & (scores <= high))
                if len(fits):
                    mine.add(scores[fits], near[fits], other[fits])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if negatives:
            best = [[Best(NEGATIVES, w[4]) for w in wanted] for wanted in queries.wanted]
        else:
            best = [[Best(POSITIVES, int(floor))] for floor in queries.floor]
        search = negatives_of if negatives else positives_of

        def over(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held)
            piece = Piece(books, *(table.column(c).to_numpy() for c in ("cell", "vec_id", "label")),
                          matrix(table.column("v").to_pylist(), books.dim).reshape(table.num_rows, books.dim))
            for i in range(len(best)):
                search(piece, i, best[i])

        held: list[pa.RecordBatch] = []
        for b in batches:
            if b.num_rows:
                held.append(b)
            if sum(x.num_rows for x in held) >= PIECE_ROWS:
                over(held)
                held = []
        if held:
            over(held)
        rows = [(int(queries.ids[i]), queries.wanted[i][n][:2] if negatives else (None, None), r)
                for i, lists in enumerate(best) for n, one in enumerate(lists) for r in one.rows]
        for at in range(0, len(rows), 10_000):
            some = rows[at : at + 10_000]
            yield pa.record_batch(
                [pa.array([r[0] for r in some], pa.int64()), pa.array([r[1][0] for r in some], pa.int64()),
                 pa.array([r[1][1] for r in some], pa.int64()), pa.array([-r[2][0] for r in some], pa.int64()),
                 pa.array([r[2][1] for r in some], pa.int64()), pa.array([r[2][2] for r in some], pa.int64())],
                names=["anchor_id", "positive_id", "positive_score", "score", "vec_id", "label"])

    return run


_FOUND = "anchor_id long, positive_id long, positive_score long, score long, vec_id long, label long"


def window(p: Column) -> tuple[Column, Column]:
    """Lowest and highest whole score s with 50 p <= 100 s <= 95 p; empty for p < 0."""
    exact = p.cast("decimal(38,0)")
    return (F.ceil(exact / 2).cast("long"), F.floor(exact * 95 / 100).cast("long"))


def _first_floor(scores: np.ndarray, k: int, floor: int) -> int:
    """The k-th highest score of some rows: k rows reach it, so it is a floor."""
    return max(floor, int(np.partition(scores, -k)[-k])) if len(scores) >= k else floor


@dataclass
class Sample:
    """The rows that the codebooks are fitted on, in the order of their labels."""

    ids: np.ndarray
    labels: np.ndarray
    scorer: Scorer

    def floors(self, dim: int) -> Callable:
        """Adds to queries (vec_id, label, v) the score that ``POSITIVES`` rows of
        the sample reach; with ``low`` and ``high``, that ``NEGATIVES`` reach between them."""
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                windows = "low" in b.schema.names
                bounds = zip(*(b.column(c).to_pylist() for c in ("low", "high")), strict=True) if windows else [None] * b.num_rows
                out = []
                for i, label, v, bound in zip(*(b.column(c).to_pylist() for c in ("vec_id", "label", "v")), bounds, strict=True):
                    q = matrix([v], dim).reshape(dim)
                    span = slice(int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, side="right")))
                    if bound is None:
                        out.append(_first_floor(self.scorer.scores(q, span)[self.ids[span] != i], POSITIVES, LONG.min))
                        continue
                    fits = self.ids != i
                    fits[span] = False
                    scores = self.scorer.scores(q)[fits]
                    out.append(_first_floor(scores[(scores >= bound[0]) & (scores <= bound[1])], NEGATIVES, bound[0]))
                yield pa.record_batch([*b.columns, pa.array(out, pa.int64())], names=[*b.schema.names, "floor"])

        return run


def _queries(rows: list, dim: int) -> Queries:
    n = len(rows)
    return Queries(np.array([r["vec_id"] for r in rows], dtype=np.int64), np.array([r["label"] for r in rows], dtype=np.int64),
                   matrix([bytes(r["v"]) for r in rows], dim).reshape(n, dim),
                   np.array([r["floor"] for r in rows], dtype=np.int64), [[] for _ in rows])


def hard_negatives(embeddings: DataFrame, every: int = EVERY, shift_labels: bool = True) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = embeddings.sparkSession
    prepare_python(spark)
    rows = stage(whole_rows(embeddings, shift_labels), "negatives-rows")
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("v")).alias("bytes"),
                     F.count_if(F.col("vec_id") % every == 0).alias("queries")).first()
    dim = (facts["bytes"] or 0) // 8
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "label", "v").limit(max(1, min(SAMPLE, QUERY_BYTES // max(1, 8 * dim)))).collect()
    drawn.sort(key=lambda r: (r["label"], r["vec_id"], bytes(r["v"])))
    sample = Sample(np.array([r["vec_id"] for r in drawn], dtype=np.int64), np.array([r["label"] for r in drawn], dtype=np.int64),
                    Scorer(matrix([bytes(r["v"]) for r in drawn], dim).reshape(len(drawn), dim)))
    books = fit_codebooks(sample.scorer.rows, facts["n"])
    index = build_index(rows, books)
    asked = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row")).select("vec_id", "row.*")
    asked = stage(asked.mapInArrow(sample.floors(dim), "vec_id long, label long, v binary, floor long"), "negatives-queries")
    n_blocks = max(1, -(-facts["queries"] // max(1, QUERY_BYTES // max(64, 8 * dim))))
    out = []
    for number in range(n_blocks):
        block = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == number)
        queries = _queries(sorted(block.collect(), key=lambda r: r["vec_id"]), dim)  # about QUERY_BYTES
        order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id", "label")
        found = index.mapInArrow(_search(books, queries, False), _FOUND).withColumn("rank", F.row_number().over(order)).filter(
            F.col("rank") <= POSITIVES).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        wanted = found.join(block.drop("floor"), F.col("anchor_id") == F.col("vec_id")).select(
            "vec_id", "label", "v", "positive_id", "positive_score", *(c.alias(n) for c, n in zip(window(F.col("positive_score")), ("low", "high"), strict=True)))
        wanted = wanted.filter("low <= high").mapInArrow(sample.floors(dim), "vec_id long, label long, v binary, positive_id long, "
                                                         "positive_score long, low long, high long, floor long")
        place = {int(i): at for at, i in enumerate(queries.ids)}
        for r in wanted.select("vec_id", "positive_id", "positive_score", "low", "high", "floor").collect():  # POSITIVES a query
            queries.wanted[place[r["vec_id"]]].append(tuple(r)[1:])
        order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id", "label")
        mined = index.mapInArrow(_search(books, queries, True), _FOUND).withColumn("rank", F.row_number().over(order)).filter(
            F.col("rank") <= NEGATIVES).select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out.append(stage(mined, "negatives-mined") if n_blocks > 1 else mined)
    whole = out[0]
    for one in out[1:]:
        whole = whole.unionByName(one)
    return whole
