"""Quality by logistic regression over hashed word n-grams.

Tokens are runs of word characters and runs of other marks, A-Z lower-cased;
every single token and every two neighbours are hashed to one of ``2**BITS``
buckets; a few more buckets count n-grams known by their repetition alone,
whatever the words. A text is the vector of its counts, scaled to length one.

Fit: at most ``SAMPLE`` labelled rows (those with the smallest hash of their
id) are dealt into ``SHARDS`` parts. In every round each part runs over its
rows one by one with follow-the-regularised-leader updates (a learning rate
for every weight, L1 and L2 terms), starting from the common state; the states
are averaged. A state is two numbers a bucket, whatever the corpus.

Score: a sparse dot product with the weights, through the logistic function.
Ids, languages and sources are never inputs.

Defined results
    null or empty text     the score of the bias alone
    no labels, one label   score 0.5 throughout
    null or other labels   not learnt from
    ties, repeated rows    each row scored alone; a doubly labelled id is
                           learnt from once a label row
    very long texts        whole, hashed in pieces
    empty table            empty result
    extra columns          ignored
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievekit.llm.common import prepare_python, stage
from sievekit.llm.tokens import _BASE, _CODE, _INVERSE, _U, PIECE, _pieces, _power, mixed, shingles

SAMPLE = 20_000  # labelled rows learnt from, at most
BITS = 18  # 2**BITS buckets
APART, REPEAT = 4, 5  # places and length of n-grams known by their repetition alone
WIDTH = (1 << BITS) + APART + 1  # buckets of hashed and of word-less n-grams
SHARDS = 4
ROUNDS, MOST_ROUNDS = 4, 16  # a small sample is run over more often,
UPDATES = 20_000  # until so many rows were learnt from
ALPHA, BETA = 0.5, 1.0  # learning rate and its delay
L1, L2 = 0.02, 0.02
ACCEPT = 0.5

#: what a byte is: 0 white space, 1 of a word, 2 another mark
_KIND = np.ones(256, dtype=np.int8)
_KIND[:128] = 2
for _span in (b"0123456789_", bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))):
    _KIND[list(_span)] = 1
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0


# ---------------------------------------------------------------- features

def _tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the tokens of a piece of bytes."""
    kind = _KIND[data]
    edge = np.flatnonzero(np.diff(kind, prepend=0, append=0))  # every change of kind
    starts, ends = edge[:-1], edge[1:]
    real = kind[starts] > 0 if len(starts) else np.empty(0, dtype=bool)
    starts, ends = starts[real], ends[real]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_CODE[data] * _power(_BASE, len(data))[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power(_INVERSE, len(data))[starts] + (ends - starts).astype(np.uint64)), starts


def token_hashes(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """Token hashes of each text, short texts hashed together."""
    held: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        lengths = np.fromiter((len(x) + 1 for x in held), dtype=np.int64, count=len(held))
        hashes, starts = _tokens(np.frombuffer(b"\n".join(held) + b"\n", dtype=np.uint8))
        yield from np.split(hashes, np.searchsorted(starts, np.cumsum(lengths)[:-1]))

    for text in texts:
        data = (text or "").encode()
        if held and size + len(data) > PIECE:
            yield from flush()
            held, size = [], 0
        if len(data) > PIECE:
            yield np.concatenate([_tokens(np.frombuffer(p, dtype=np.uint8))[0] for p in _pieces(data)])
        else:
            held.append(data)
            size += len(data) + 1
    if held:
        yield from flush()


def features(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text's tokens: counts of single tokens, of two
    neighbours, and of the word-less n-grams "x ... x" (a token that stands
    1 to ``APART`` places before too) and "the same ``REPEAT`` tokens again";
    scaled to length one."""
    if not len(tokens):
        return np.empty(0, dtype=np.int64), np.empty(0)
    grams = [mixed(tokens * _U(_BASE))]
    if len(tokens) > 1:
        grams.append(mixed((tokens[:-1] * _U(_BASE) + tokens[1:]) * _U(_BASE) + _U(2)))
    bucket, count = np.unique(np.concatenate(grams) >> _U(64 - BITS), return_counts=True)
    again = [int((tokens[k:] == tokens[:-k]).sum()) for k in range(1, APART + 1)]
    run = shingles(tokens, REPEAT)
    again.append(max(0, len(tokens) - REPEAT + 1 - len(run)))
    bucket = np.concatenate([bucket.astype(np.int64), (1 << BITS) + np.flatnonzero(again)])
    value = np.concatenate([count, [x for x in again if x]]).astype(np.float64)
    return bucket, value / np.sqrt((value**2).sum())


# ---------------------------------------------------------------- fitting

class Leader:
    """Follow-the-regularised-leader over sparse rows: ``z`` and ``n`` are the
    sums of adjusted gradients and of their squares, one of each a bucket; the
    last is the bias."""

    def __init__(self, z: np.ndarray | None = None, n: np.ndarray | None = None):
        self.z = np.zeros(WIDTH + 1) if z is None else z
        self.n = np.zeros(WIDTH + 1) if n is None else n

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, bucket: np.ndarray, value: np.ndarray, label: int) -> None:
        at, x = np.append(bucket, WIDTH), np.append(value, 1.0)
        w = self.weights(at)
        g = (logistic(float(w @ x)) - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def logistic(z: float | np.ndarray) -> float | np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


@dataclass
class Model:
    """Weights of the buckets that have one, and the bias."""

    bucket: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(WIDTH)
        out[self.bucket] = self.weight
        return out


def _feature_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [features(t) for t in token_hashes(b.column("text").to_pylist())]
        yield pa.record_batch([b.column("shard"), b.column("turn"), b.column("label"), pa.array([f[0].astype("<i4").tobytes() for f in found], pa.binary()),
                               pa.array([f[1].astype("<f4").tobytes() for f in found], pa.binary())],
                              names=["shard", "turn", "label", "bucket", "value"])


def _learnt(z: np.ndarray, n: np.ndarray) -> Callable:
    """A pass of every shard over its rows, from the common state; yields what changed."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, leader = None, None

        def changed() -> pa.RecordBatch:
            at = np.flatnonzero((leader.z != z) | (leader.n != n))
            found = at.astype("<i4"), leader.z[at] - z[at], leader.n[at] - n[at]
            return pa.record_batch([pa.array([now], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in found)],
                                   names=["shard", "at", "z", "n"])

        for b in batches:
            for shard, label, bucket, value in zip(*(b.column(c).to_pylist() for c in ("shard", "label", "bucket", "value")), strict=True):
                if shard != now:
                    if leader is not None:
                        yield changed()
                    now, leader = shard, Leader(z.copy(), n.copy())
                leader.learn(np.frombuffer(bucket, "<i4"), np.frombuffer(value, "<f4").astype(np.float64), label)
        if leader is not None:
            yield changed()

    return run


def fit_quality(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from the labelled documents whose label row meets ``may_learn``."""
    prepare_python(docs.sparkSession)
    rows = labels.filter(may_learn) if may_learn is not None else labels
    rows = rows.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label")).filter("label in (0, 1)")
    chosen = stage(rows.orderBy(F.xxhash64("label_id"), "label_id", "label").limit(sample), "quality-sample")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # the sample is bounded, so it is broadcast; the documents are read once
    learnt = texts.join(F.broadcast(chosen), F.col("id") == F.col("label_id")).select(
        F.pmod(F.xxhash64("label_id"), F.lit(SHARDS)).cast("int").alias("shard"),
        F.xxhash64("label_id", F.lit(1), "text", "label").alias("turn"), "label", "text")
    rows = learnt.mapInArrow(_feature_rows, "shard int, turn long, label int, bucket binary, value binary")
    learnt = stage(rows.repartitionByRange(SHARDS, "shard").sortWithinPartitions("shard", "turn"), "quality-features")  # a file a shard
    counts = {r["label"]: r["count"] for r in learnt.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Model(np.empty(0, np.int64), np.empty(0), 0.0)
    leader = Leader()
    rounds = min(MOST_ROUNDS, max(ROUNDS, UPDATES // sum(counts.values())))
    for _ in range(rounds):
        # what changed in a shard: at most 20 bytes a bucket
        found = learnt.mapInArrow(_learnt(leader.z, leader.n), "shard int, at binary, z binary, n binary").collect()
        for r in sorted(found, key=lambda r: (r["shard"], len(r["at"]))):  # in one order, so that sums are the same each time
            at = np.frombuffer(r["at"], "<i4")
            leader.z[at] += np.frombuffer(r["z"]) / len(found)
            leader.n[at] += np.frombuffer(r["n"]) / len(found)
    w = leader.weights()
    bucket = np.flatnonzero(w[:-1])
    return Model(bucket, w[bucket], float(w[-1]))


# ---------------------------------------------------------------- scoring

def _scores(model: Model) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.dense()
        for b in batches:
            found = (features(t) for t in token_hashes(b.column("text").to_pylist()))
            yield pa.record_batch([b.column("id"), pa.array([float(logistic(weights[at] @ x + model.bias)) for at, x in found], pa.float64())],
                                  names=["id", "score"])

    return run


def quality_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, score."""
    prepare_python(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _scores(model), f"id {kind}, score double").withColumnRenamed("id", id_col)
