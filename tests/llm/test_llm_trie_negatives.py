"""Conversation trie and hard negatives against brute force."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sievekit.llm.hard_negatives import Scorer, codebook, fit_codebooks, hard_negatives
from sievekit.llm.prefix_trie import Parentheses, _closing, prefix_trie
from sievekit.llm.queries import ORACLE_SQL, QUERIES
from tools.compare import compare, duck

SF = "/root/testdata/sf0.001"
CONV = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("name", ["op11_conversation_prefix_trie", "op13_hard_negatives"])
def test_query_matches_its_sql(spark, name):
    problems, n, _ = compare(spark, duck(SF), name, QUERIES[name], ORACLE_SQL[name], SF)
    assert not problems and n


# ------------------------------------------------------------ trie

def digest(turn):
    return hashlib.md5(f"{len(turn[0].encode())}:{turn[0]}{turn[1]}".encode()).digest()


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", digest((role or "", text or "")), text or ""))
    own = {c: [(r[2], r[4]) for r in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(math.fmod(c, 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute_trie(rows):
    paths = rebuilt(rows)
    members, children = defaultdict(list), defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[tuple(p[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[x] for x in children[node])
    out = []
    for node, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(paths[c]) == len(node))
        out.append((min(found), len(node), min(members[node[:-1]]) if node else None, len(found), len(children[node]),
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def random_conversations(n, seed, deep=0, copies=0):
    g = random.Random(seed)
    rows = [(None, 1, "user", "x")]
    for c in range(-n // 4, n):
        if g.random() < 0.2:
            continue
        turns = [("user", "hello")] if g.random() < 0.6 else []
        turns += [(g.choice(["user", "assistant", None]), g.choice(["a", "b", "é", None, ""])) for _ in range(g.randrange(12))]
        rows += [(c, i if g.random() > 0.05 else g.choice([None, 3]), r, x) for i, (r, x) in enumerate(turns)]
    for c in (n + 5, n + 6, n + 11):
        rows += [(c, i, "user", str(i % 3)) for i in range(deep - (c % 5) * 10)]
    for c in range(10 * n, 10 * n + copies):
        rows += [(c, i, "user", f"same {i}") for i in range(12)]
    g.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "seed", "deep", "copies"), [(3, 0, 0, 0), (60, 1, 0, 0), (60, 2, 700, 0), (40, 3, 0, 300)])
def test_trie_equals_brute_force(spark, n, seed, deep, copies):
    rows = random_conversations(n, seed, deep, copies)
    df = spark.createDataFrame(rows, CONV).repartition(5)
    assert sorted((tuple(r) for r in prefix_trie(df).collect()), key=lambda r: r[:2]) == brute_trie(rows)


def test_trie_of_no_and_of_single_conversations(spark):
    assert prefix_trie(spark.createDataFrame([], CONV)).collect() == []
    assert prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], CONV)).collect() == []
    for rows in ([(7, 1, None, None)], [(0, None, "user", "x")], [(12, 1, "a", "b"), (12, 1, "a", "b")]):
        got = sorted(tuple(r) for r in prefix_trie(spark.createDataFrame(rows, CONV)).collect())
        assert got == brute_trie(rows)


def test_trie_ignores_extra_columns_with_names_of_its_own(spark):
    rows = random_conversations(20, 5)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], CONV + ", c int, id string, depth int")
    assert sorted((tuple(r) for r in prefix_trie(df).collect()), key=lambda r: r[:2]) == brute_trie(rows)


def test_a_long_conversation_is_spread_over_partitions(spark):
    """One conversation holds nearly all rows: its turns, prefixes and nodes lie in many shards."""
    rows = [(10, i, "user", str(i)) for i in range(4000)] + [(11, i, "user", str(i)) for i in range(3990)] + [(3, 0, "user", "0")]
    got = prefix_trie(spark.createDataFrame(rows, CONV).repartition(4))
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[:2]) == brute_trie(rows)


def random_depths(g, n):
    out = [g.randrange(5)]
    while len(out) < n:
        out.append(g.randrange(max(0, out[-1] - g.choice([0, 1, 3, 40, 2000])), out[-1] + 2))
    return out


@pytest.mark.parametrize("seed", range(30))
def test_findclose(seed):
    g = random.Random(seed)
    depth = random_depths(g, g.choice([1, 2, 60, 3000]))
    ends = Parentheses(np.array(depth)).ends()
    stack, want = [], [len(depth)] * len(depth)
    for i, d in enumerate(depth):
        while stack and depth[stack[-1]] >= d:
            want[stack.pop()] = i
        stack.append(i)
    assert ends.tolist() == want


def test_open_nodes_find_the_shard_that_closes_them():
    import pyarrow as pa

    low, leaves, saved = np.array([0, 5, 9, 3, 1]), np.array([1, 2, 4, 8, 16]), np.array([0, 1, 0, 1, 0])
    batch = pa.record_batch([pa.array([0, 0, 0, 2, 4], pa.int32()), pa.array([0, 4, 7, 3, 2]), pa.array([0] * 5), pa.array([0] * 5)],
                            names=["part", "depth", "leaves", "saved"])
    out = next(_closing(low, leaves, saved)([batch])).to_pydict()
    assert out["closer"] == [5, 3, 1, 3, 5]
    assert out["leaves"] == [30, 6, 0, 0, 0]


# ------------------------------------------------------------ hard negatives

EMB = "vec_id long, embedding array<double>, label int"


def brute_negatives(rows):
    kept = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    anchors = {}
    for i, y, v in sorted(kept):
        if i % 50 == 0:
            anchors.setdefault(i, (y, v))
    out = []
    for a, (y, v) in anchors.items():
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, z) for i, z, w in kept if i != a)
        for s, p, _ in [r for r in scored if r[2] == y][:5]:
            found = [r for r in scored if r[2] != y and 50 * -s <= 100 * -r[0] <= 95 * -s][:3]
            out += [(a, p, n + 1, r[1], -s, -r[0]) for n, r in enumerate(found)]
    return sorted(out)


def vectors(n, dim, seed, spread=0.2, groups=6):
    g = np.random.default_rng(seed)
    centres = g.normal(size=(groups, dim))
    return [(int(i), [float(x) for x in centres[i % groups] + spread * g.normal(size=dim)], int(g.integers(4))) for i in range(n)]


@pytest.mark.parametrize(("n", "dim", "spread"), [(400, 8, 0.2), (1500, 16, 1.0), (300, 1, 0.5), (120, 3, 0.0)])
def test_negatives_equal_brute_force(spark, n, dim, spread):
    rows = vectors(n, dim, n, spread)
    assert sorted(tuple(r) for r in hard_negatives(spark.createDataFrame(rows, EMB).repartition(6)).collect()) == brute_negatives(rows)


def test_negatives_with_nulls_odd_lengths_and_huge_components(spark):
    rows = vectors(260, 4, 9)
    rows += [(1000, None, 1), (1001, [1.0, None, 2.0], 1), (1002, [math.nan, 1.0], 2), (1003, [math.inf], 1), (1004, [1.0], None),
             (None, [1.0, 2.0], 1), (1050, [0.5, 0.5], 1), (1051, [], 1), (1052, [1.0] * 6, 2), (1100, [3e6, -3e6, 3e6], 3),
             (1101, [2e6, 1.0, 3e6], 3), (1102, [2.5e6, 0.0, 1.5e6], 2), (1150, [], 0)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], EMB + ", v string, cell int")
    assert sorted(tuple(r) for r in hard_negatives(df).collect()) == brute_negatives(rows)


def test_negatives_of_many_equal_vectors_and_ids(spark):
    rows = [(i, [1.0, 0.5, 0.25], i % 3) for i in range(700)] + [(i, [0.8, 0.5, 0.25], i % 4) for i in range(700, 900)]
    rows += [(100, [0.9, 0.1, 0.1], 2), (31, [1.0, 0.5, 0.25], 1), (31, [1.0, 0.5, 0.25], 1)]
    got = sorted(tuple(r) for r in hard_negatives(spark.createDataFrame(rows, EMB)).collect())
    want = brute_negatives(rows)
    assert got == want and want


def test_negatives_of_an_empty_table(spark):
    assert hard_negatives(spark.createDataFrame([], EMB)).collect() == []
    assert hard_negatives(spark.createDataFrame([(50, None, 1)], EMB)).collect() == []


def test_several_blocks_of_queries(spark, monkeypatch):
    from sievekit.llm import hard_negatives as module

    monkeypatch.setattr(module, "QUERY_BYTES", 8 * 8 * 3)  # three queries a block, and a sample of three rows
    rows = vectors(500, 8, 3, 0.4)
    assert sorted(tuple(r) for r in hard_negatives(spark.createDataFrame(rows, EMB)).collect()) == brute_negatives(rows)


def test_scores_are_exact_beyond_doubles():
    big = np.array([[2**40, 1], [2**20, -1]], dtype=np.int64)
    assert Scorer(big).scores(np.array([2**20, 3])).tolist() == [2**60 + 3, 2**40 - 3]


def test_codebook_words_are_means_of_their_points():
    points = np.array([[0.0], [1.0], [10.0], [11.0]])
    assert sorted(codebook(points, 2)[:, 0]) == [0.5, 10.5]
    assert len(codebook(np.zeros((5, 2)), 3)) == 1
    assert fit_codebooks(np.zeros((0, 4), dtype=np.int64), 0).dim == 4
