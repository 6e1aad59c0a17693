"""Toxicity by maximum-scoring segments of token log-odds.

Fit: over at most ``SAMPLE`` labelled documents (those with the smallest hash
of their id), documents of either label are counted per token, a token being a
word or one of its prefixes. A token's log-odds with a Dirichlet prior
proportional to its overall frequency, over their standard deviation, say
which tokens mark toxic text. Each word takes the log-odds of its longest
supported prefix; a word without evidence costs ``DRIFT``.

Score: a linear scan finds every maximal-scoring segment of a document (no
caps). For a document of n words the largest score of clean text follows an
extreme-value law 1 - exp(-K n exp(-lambda x)), fitted to clean documents held
back from the counting; segments beyond its ``SIGNIFICANCE`` are the toxic
passages, and a logistic curve over their strength gives the score.

Tokens are counted and scored in Spark, all of them; only those that mark toxic
text, the ones that shield their prefixes, and a few numbers reach the driver
(``SAMPLE`` bounds what is learnt from). Ids, languages and sources are never inputs of a score.

Defined results
    null or empty text     no passage: the score of a clean document
    no labels, one label   no token marks anything: score 0 throughout
    null labels            not learnt from
    ties, repeated rows    each row scored alone; a doubly labelled id is
                           learnt from once per label row
    very long texts        whole, in one pass
    empty table            empty result
    extra columns          ignored by ``toxicity_scores``, kept by ``clean_documents``
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievekit.llm.common import prepare_python, stage, without_ids

SAMPLE = 20_000  # labelled documents learnt from, at most
PREFIXES = range(4, 11)
SUPPORT = 6  # documents that a token needs
EVIDENCE = 2.75  # standard deviations from which a token marks toxic text
GAIN = 1.5  # log-odds that it needs besides; below, a token tells languages apart, not toxic text
PRIOR, PRIOR_SHARE = 200.0, 0.1  # weight of the Dirichlet prior, in documents: a share of those counted, at most so many
HELD_TOKENS = 100_000  # tokens that a task counts before it passes them on
DRIFT = 0.25
SIGNIFICANCE = 0.05
REJECT = 0.7

_WORD = re.compile(r"\w+")


def tokens_of(words: Iterable[str]) -> set[str]:
    """A word ends in a space, so that it differs from an equal prefix."""
    distinct = set(words)
    return {w[:k] for w in distinct for k in PREFIXES if k < len(w)} | {w + " " for w in distinct}


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


@dataclass
class Model:
    """Marks of toxic tokens, and the calibration of segment scores."""

    score: dict[str, float] = field(default_factory=dict)
    heads: set[str] = field(default_factory=set)  # shortest prefixes of scored tokens
    lam: float = 1.0
    k: float = 1.0
    weights: tuple[float, ...] = ()

    def word_score(self, word: str) -> float:
        if word + " " in self.score:
            return self.score[word + " "]
        for n in range(min(len(word), PREFIXES[-1]), PREFIXES[0] - 1, -1):
            if (s := self.score.get(word[:n])) is not None:
                return s
        return 0.0

    def marks(self, text: str | None) -> tuple[int, list[tuple[int, float]]]:
        """Number of words, and (place, score) of those that score above 0."""
        words = words_of(text)
        heads, first = self.heads, PREFIXES[0]
        # a word shorter than the shortest prefix has the head of its whole-word token, with the space
        found = [(i, w) for i, w in enumerate(words) if (w[:first] if len(w) >= first else (w + " ")[:first]) in heads]
        times: Counter[str] = Counter()
        out = []
        for i, w in found:
            if (s := self.word_score(w)) > 0:
                times[w] += 1
                out.append((i, s / times[w]))  # the evidence is a word's presence; repeats add ever less
        return len(words), out

    def segments(self, text: str | None) -> tuple[int, list[tuple[float, int, int]]]:
        """Number of words, and all maximal-scoring segments (score, first, last word)."""
        n, marks = self.marks(text)
        return n, maximal_segments(marks, DRIFT)

    def p_value(self, score: float, n: int) -> float:
        """Chance that clean text of n words has a segment of that score."""
        return -math.expm1(-min(700.0, self.k * n * math.exp(-self.lam * score)))

    def passages(self, n: int, found: list[tuple[float, int, int]]) -> list[tuple[float, int, int]]:
        return [s for s in found if self.p_value(s[0], n) <= SIGNIFICANCE]

    def features(self, n: int, found: list[tuple[float, int, int]]) -> list[float]:
        if not found:
            return [1.0, 0.0, 0.0, 0.0]
        # bits by which segments exceed what chance brings in so many words
        bits = sorted((max(0.0, self.lam * s - math.log(self.k * n)) for s, _, _ in found), reverse=True)
        return [1.0, math.log1p(bits[0]), math.log1p(sum(bits)), float(sum(b > 0 for b in bits) > 1)]

    def toxicity(self, n: int, found: list[tuple[float, int, int]]) -> float:
        if not self.weights:
            return 0.0
        z = sum(w * x for w, x in zip(self.weights, self.features(n, found), strict=True))
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, z))))


def maximal_segments(marks: list[tuple[int, float]], drift: float) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments of a sequence that scores ``-drift`` at
    every place but the marked ones, in linear time: candidates are kept with
    the sums left and right of them; a new one joins back to the nearest
    candidate that starts lower while it ends higher."""
    left: list[float] = []
    right: list[float] = []
    span: list[tuple[int, int]] = []
    back: list[int] = []  # nearest earlier candidate with a smaller left sum
    total, at = 0.0, 0
    for place, score in marks:
        total -= drift * (place - at)
        lo, hi, first = total, total + score, place
        total, at = hi, place + 1
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= lo:
                j = back[j]
            if j < 0 or right[j] >= hi:
                break
            lo, first = left[j], span[j][0]
            del left[j:], right[j:], span[j:], back[j:]
        left.append(lo)
        right.append(hi)
        span.append((first, place))
        back.append(j)
    return [(r - x, *s) for x, r, s in zip(left, right, span, strict=True)]


# ---------------------------------------------------------------- fitting

def _count_tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())
    for b in batches:
        for text, toxic in zip(b.column("_text").to_pylist(), b.column("_toxic").to_pylist(), strict=True):
            counts[toxic].update(tokens_of(words_of(text)))
            if len(counts[0]) + len(counts[1]) > HELD_TOKENS:
                yield _counted(counts)
                counts = (Counter(), Counter())
    yield _counted(counts)


def _counted(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
    names = list(counts[0] | counts[1])
    return pa.record_batch([pa.array(names, pa.string()), pa.array([counts[1][w] for w in names], pa.int64()),
                            pa.array([counts[0][w] for w in names], pa.int64())], names=["token", "toxic", "clean"])


def token_scores(counted: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """(token, score): log-odds (in nats) of the tokens that mark toxic text, and
    0 for supported tokens that shield their prefixes."""
    total = n_toxic + n_clean
    prior = min(PRIOR, PRIOR_SHARE * total)
    a = F.col("toxic") + F.lit(prior) * (F.col("toxic") + F.col("clean")) / total
    b = F.col("clean") + F.lit(prior) * (F.col("toxic") + F.col("clean")) / total
    # half a document without it, for a token that all documents of a label have
    gain = F.log(a / F.greatest(F.lit(n_toxic + prior) - a, F.lit(0.5))) - F.log(b / F.greatest(F.lit(n_clean + prior) - b, F.lit(0.5)))
    marks = (F.col("gain") >= GAIN) & (F.col("gain") / F.sqrt(1 / a + 1 / b) >= EVIDENCE)
    scored = stage(counted.filter(F.col("toxic") + F.col("clean") >= SUPPORT).withColumn("gain", gain).select(
        "token", F.substring("token", 1, PREFIXES[0]).alias("head"), F.when(marks, F.col("gain")).otherwise(0.0).alias("score")), "toxic-tokens")
    heads = scored.filter("score > 0").select("head").distinct()
    return scored.join(heads, "head", "left_semi").select("token", "score")


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 200, ridge: float = 1e-2) -> tuple[float, ...]:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _segment_rows(model: Model) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [model.segments(t) for t in b.column("_text").to_pylist()]
            yield pa.record_batch([b.column("_toxic"), pa.array([n for n, _ in found], pa.int64()),
                                   pa.array([max((s for s, _, _ in f), default=0.0) for _, f in found], pa.float64())],
                                  names=["toxic", "n", "best"])

    return run


def _feature_rows(model: Model) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column("_toxic"), pa.array([model.features(*model.segments(t)) for t in b.column("_text").to_pylist()],
                                                                pa.list_(pa.float64()))], names=["toxic", "x"])

    return run


def extreme_value_law(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """(lambda, K) from the best segment scores of clean documents: moments of
    the tail log-survival over the scores above 0."""
    hit = best > 0
    words = max(1.0, float(n.sum()))
    if hit.sum() < 10:
        return 1.0, max(1.0, float(hit.sum())) / words
    lam = 1.0 / max(1e-6, float(best[hit].mean() - best[hit].min() + 1e-3))
    lam = min(5.0, max(0.05, lam))
    # so many clean segments per word exceed x: K exp(-lambda x)
    return lam, float(hit.sum()) / words * math.exp(lam * float(best[hit].min()))


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from the labelled documents whose label row meets ``may_learn``."""
    prepare_python(docs.sparkSession)
    rows = labels.filter(may_learn) if may_learn is not None else labels
    rows = rows.select(F.col(id_col).alias("_label_id"), F.col(label_col).cast("int").alias("_toxic")).filter("_toxic in (0, 1)")
    chosen = stage(rows.orderBy(F.xxhash64("_label_id"), "_label_id", "_toxic").limit(sample), "toxic-sample")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # the sample is bounded, so it is broadcast; its documents are read once
    learnt = texts.join(F.broadcast(chosen), F.col("_id") == F.col("_label_id")).select(
        "_text", "_toxic", (F.pmod(F.xxhash64("_label_id", F.lit(1)), F.lit(4)) == 0).alias("_held"))
    learnt = stage(learnt, "toxic-learnt")
    counting = learnt.filter("not _held")
    n = {r["_toxic"]: r["count"] for r in counting.groupBy("_toxic").count().collect()}
    if len(n) < 2:
        return Model()
    counted = counting.mapInArrow(_count_tokens, "token string, toxic long, clean long").groupBy("token").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    score = {r["token"]: r["score"] for r in token_scores(counted, n[1], n[0]).collect()}
    model = Model(dict(sorted(score.items())), {t[: PREFIXES[0]] for t in score})
    held = learnt.filter("_held")
    clean = np.array([(r["n"], r["best"]) for r in held.filter("_toxic = 0").mapInArrow(
        _segment_rows(model), "toxic int, n long, best double").collect()], dtype=float).reshape(-1, 2)
    model.lam, model.k = extreme_value_law(clean[:, 1], clean[:, 0])
    points = held.mapInArrow(_feature_rows(model), "toxic int, x array<double>").collect()
    if len({r["toxic"] for r in points}) == 2:
        points.sort(key=lambda r: (r["toxic"], r["x"]))
        model.weights = _logistic(np.array([r["x"] for r in points]), np.array([r["toxic"] for r in points], dtype=float))
    return model


# ---------------------------------------------------------------- scoring

def _score_rows(model: Model) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [model.segments(t) for t in b.column("_text").to_pylist()]
            passages = [model.passages(*f) for f in found]
            yield pa.record_batch(
                [b.column("_id"), pa.array([model.toxicity(*f) for f in found], pa.float64()),
                 pa.array([[{"first_word": a, "last_word": z, "score": s} for s, a, z in p] for p in passages],
                          pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("score", pa.float64())])))],
                names=["_id", "score", "passages"])

    return run


def toxicity_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, score, passages (first and last word, score)."""
    prepare_python(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return texts.mapInArrow(_score_rows(model), f"_id {kind}, score double, passages array<struct<first_word:int,last_word:int,score:double>>"
                            ).withColumnRenamed("_id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """Ids that are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def clean_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    reject: float = REJECT) -> DataFrame:
    """``docs`` without the documents scored ``reject`` or higher."""
    bad = toxicity_scores(docs, model, id_col, text_col).filter(F.col("score") >= reject)
    return without_ids(docs, id_col, bad.select(id_col), "toxic-rejected")
