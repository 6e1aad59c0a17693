"""Quality classifier: features against a plain version, held-out accuracy, edge rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievekit.llm.quality import APART, BITS, REPEAT, WIDTH, Leader, Model, features, fit_quality, quality_scores, token_hashes
from sievekit.llm.queries import op12_quality_classifier, table
from sievekit.llm.tokens import PIECE
from sievekit.llm.toxicity import held_out

TOKEN = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[^0-9A-Za-z_\x80-\xff\x20\x09-\x0d]+")
TEXTS = ["A b  a,b!! é-é", "", None, "   \n\t", "x", "$$$", "one one one one", "a\x0bb", "word " * 40, "Ünï cödé. ünï", "a\x00b a\x00b"]


def plain_tokens(text):
    # A-Z alone are lower-cased
    return TOKEN.findall((text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")))


def test_tokens_are_runs_of_word_and_of_other_characters():
    seen = {}
    for text, hashes in zip(TEXTS, token_hashes(TEXTS), strict=True):
        words = plain_tokens(text)
        assert len(words) == len(hashes), text
        for w, h in zip(words, hashes.tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_texts_are_hashed_whole():
    text = "Some, words! " * (PIECE // 4)
    got = next(token_hashes([text]))
    short = next(token_hashes(["Some, words!"]))
    assert len(got) == 4 * (PIECE // 4) and (got.reshape(-1, 4) == short).all()


def test_features_count_single_tokens_pairs_and_repetitions():
    for text in TEXTS + ["a b c d e a b c d e", "a b a b a b"]:
        tokens = next(token_hashes([text]))
        bucket, value = features(tokens)
        words = plain_tokens(text)
        want = Counter()
        for n in Counter(words).values():
            want[n] += 1
        for n in Counter(zip(words, words[1:])).values():
            want[n] += 1
        hashed = bucket < 1 << BITS
        size = math.sqrt(sum(v * v for v in value)) and 1.0
        scale = min(value) if len(value) else 1.0
        plain = Counter(round(v / scale * 1e6) for v in value[hashed])
        assert abs((value**2).sum() - size) < 1e-9
        again = {k: sum(a == b for a, b in zip(words, words[k:])) for k in range(1, APART + 1)}
        runs = [tuple(words[i : i + REPEAT]) for i in range(len(words) - REPEAT + 1)]
        again[APART + 1] = len(runs) - len(set(runs))
        unit = None if not len(value) else math.sqrt(sum(n * n * c for n, c in want.items()) + sum(n * n for n in again.values()))
        assert {int(b) - (1 << BITS) + 1: round(v * unit) for b, v in zip(bucket[~hashed], value[~hashed])} == {k: n for k, n in again.items() if n}
        assert Counter(round(v * unit) for v in value[hashed]) == want if unit else not plain


def test_leader_follows_the_update_rule():
    """One coordinate and the bias, by hand."""
    from sievekit.llm.quality import ALPHA, BETA, L1, L2

    leader, at, x = Leader(), np.array([5]), np.array([0.5])
    z, n = {5: 0.0, WIDTH: 0.0}, {5: 0.0, WIDTH: 0.0}
    for label in (1, 0, 1, 1):
        w = {i: 0.0 if abs(z[i]) <= L1 else (math.copysign(L1, z[i]) - z[i]) / ((BETA + math.sqrt(n[i])) / ALPHA + L2) for i in z}
        p = 1 / (1 + math.exp(-(0.5 * w[5] + w[WIDTH])))
        for i, v in ((5, 0.5), (WIDTH, 1.0)):
            g = (p - label) * v
            s = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / ALPHA
            z[i], n[i] = z[i] + g - s * w[i], n[i] + g * g
        leader.learn(at, x, label)
    assert np.allclose([leader.z[5], leader.z[WIDTH], leader.n[5], leader.n[WIDTH]], [z[5], z[WIDTH], n[5], n[WIDTH]])


@pytest.mark.parametrize(("sf", "least"), [("sf0.001", 0.9), ("sf0.01", 0.97)])
def test_held_out_accuracy(spark, sf, least):
    rows = op12_quality_classifier(spark, f"/root/testdata/{sf}").join(table(spark, f"/root/testdata/{sf}", "labels"), "doc_id").filter(
        "held_out").collect()
    good = [r for r in rows if r["quality"] == 1]
    bad = [r for r in rows if r["quality"] == 0]
    assert sum(r["predicted"] == r["quality"] for r in rows) >= least * len(rows)
    assert sum(g["score"] > b["score"] for g in good for b in bad) >= 0.97 * len(good) * len(bad)


def test_whole_table_is_scored_alike_each_time(spark):
    sf = "/root/testdata/sf0.001"
    one, two = ({r["doc_id"]: r["score"] for r in op12_quality_classifier(spark, sf).collect()} for _ in range(2))
    assert one == two and len(one) == table(spark, sf, "documents").count()


def test_scores_see_the_text_alone_and_held_out_labels_are_not_learnt(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    flipped = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = fit_quality(docs, labels, ~held_out()), fit_quality(docs, flipped, ~held_out())
    assert (a.bucket == b.bucket).all() and (a.weight == b.weight).all() and a.bias == b.bias
    moved = docs.withColumn("doc_id", F.col("doc_id") + 7).withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    one = {r["doc_id"] + 7: r["score"] for r in quality_scores(docs, a).collect()}
    assert {r["doc_id"]: r["score"] for r in quality_scores(moved, a).collect()} == one


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "x " * 200_000), (None, "a b"), (5, "a b"), (5, "a b")]
    model = Model(np.array([3]), np.array([0.5]), 0.25)
    docs = spark.createDataFrame([(*r, "s", 1.0) for r in rows], "doc_id long, text string, id string, score double")
    got = [(r["doc_id"], r["score"]) for r in quality_scores(docs, model).collect()]
    assert len(got) == len(rows)
    plain = 1 / (1 + math.exp(-0.25))
    assert all(abs(s - plain) < 1e-12 for i, s in got if i in (1, 2, 3))
    assert quality_scores(docs.limit(0), model).collect() == []


def test_without_labels_or_with_one_label_the_score_is_a_half(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "doc_id long, text string")
    for labels in ([], [(i, 1) for i in range(6)], [(1, None), (2, 7)]):
        model = fit_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert {r["score"] for r in quality_scores(docs, model).collect()} == {0.5}
