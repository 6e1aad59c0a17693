"""Exact dedup, line chunks, n-gram join and connected components against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sievekit.llm.components import connected_components
from sievekit.llm.exact_dedup import drop_exact_copies, exact_groups
from sievekit.llm.line_chunks import DIVISOR, LEVELS, WINDOW, chunk_report, drop_repeated_chunks, passage_report
from sievekit.llm.common import stage
from sievekit.llm.ngram_join import components_of, linked_pairs, needed, one_of_each, overlaps, shared_at_least, shingle_components
from sievekit.llm.ngram_join import THRESHOLD, _class_of
from sievekit.llm.queries import op6_line_chunk_dedup
from sievekit.llm.tokens import PIECE, each_word_hashes, shingles, word_hashes

SPACES = re.compile(r"[\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
DOCS = "doc_id long, text string"


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


# ------------------------------------------------------------ exact dedup

EXACT = [(5, "a  b"), (3, "a b"), (9, "a\tb\n"), (1, "a b "), (2, None), (4, ""), (7, " "), (8, "a b"),
         (6, "x" * 300_000), (11, "x" * 300_000), (11, "x" * 300_000), (None, "alone"), (None, "a b")]


def brute_groups(rows):
    texts = [SPACES.sub(" ", t or "") for _, t in rows]
    ids = defaultdict(list)
    for (i, _), t in zip(rows, texts):
        ids[t].append(i)
    keep = {t: min((i for i in v if i is not None), default=None) for t, v in ids.items()}
    return sorted(((i, keep[t], len(ids[t]), i == keep[t], hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(rows, texts)),
                  key=str)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, weak):
    hash_of = {"hash_128": lambda c: F.unhex(F.lit("00"))} if weak else {}  # every text collides
    df = spark.createDataFrame(EXACT, DOCS).withColumn("_h", F.lit(1)).withColumn("keep_id", F.lit("x"))
    got = sorted((tuple(r) for r in exact_groups(df, **hash_of).collect()), key=str)
    assert got == brute_groups(EXACT)


def test_exact_without_broadcast(spark):
    df = spark.createDataFrame(EXACT, DOCS)
    got = sorted((tuple(r) for r in exact_groups(df, max_broadcast_bytes=-1).collect()), key=str)
    assert got == brute_groups(EXACT)
    left = drop_exact_copies(df.withColumn("gone", F.lit(1)))
    assert left.columns == ["doc_id", "text", "gone"]
    gone = {i for i, *_, kept, _ in brute_groups(EXACT) if not kept and i is not None}
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(i for i, _ in EXACT if i not in gone)
    assert exact_groups(spark.createDataFrame([], DOCS)).collect() == []


# ------------------------------------------------------------ line chunks

def xx(data, seed=42):
    h = xxhash.xxh64_intdigest(data, seed=seed)
    return h - (1 << 64) if h >= 1 << 63 else h


def brute_chunks(text):
    lines = text.split("\n")
    hashes = [xx(x.encode()) for x in lines]
    out, begin = [], 0
    for i in range(len(lines)):
        cut = i + 1 == len(lines)
        if i + 1 >= WINDOW:
            roll = 42
            for h in hashes[i + 1 - WINDOW : i + 1]:
                roll = xx((h % (1 << 64)).to_bytes(8, "little"), roll % (1 << 64))
            cut |= roll % DIVISOR == 0
        if cut:
            out.append(lines[begin : i + 1])
            begin = i + 1
    return out


def brute_report(rows):
    places = defaultdict(list)
    for i, t in rows:
        for at, c in enumerate(brute_chunks(t) if t is not None else []):
            if len(c) >= 2:
                places["\n".join(c)].append((i, at))
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, 0, 0, 0, None, None))
            continue
        parts = brute_chunks(t)
        kept = [c for at, c in enumerate(parts) if len(c) < 2 or min(places["\n".join(c)]) == (i, at)]
        left = "\n".join(x for c in kept for x in c)
        out.append((i, len(t.split("\n")), len(parts), len(parts) - len(kept), len(t) - len(left), left))
    return sorted(out, key=str)


def line_rows():
    rnd = random.Random(3)
    passage = [f"shared line {k} of the passage" for k in range(9)]
    rows = [(1, None), (2, ""), (3, "one line"), (4, "\n\n\n"), (5, "\n\n\n"), (6, "one line")]
    for i in range(10, 40):
        body = [f"own {i} {k} {rnd.random()}" for k in range(rnd.randint(0, 12))]
        at = rnd.randint(0, len(body))
        rows.append((i, "\n".join(body[:at] + (passage if i % 3 else []) + body[at:])))
    rows.append((50, "\n".join(f"long {k % 700}" for k in range(3000))))
    return rows


@pytest.mark.parametrize("weak", [False, True])
def test_chunk_report(spark, weak):
    rows = line_rows()
    hash_of = {"hash_of": lambda c: F.unhex(F.lit("00"))} if weak else {}
    df = spark.createDataFrame(rows, DOCS).withColumn("_at", F.lit(1)).withColumn("gone", F.lit("x")).repartition(5)
    got = sorted((tuple(r) for r in chunk_report(df, **hash_of).collect()), key=str)
    assert got == brute_report(rows)
    assert sum(r[3] for r in got) > 20


def test_chunks_repeated_rows_and_empty_table(spark):
    rows = [(1, "a\nb\nc\nd\ne\nf"), (1, "a\nb\nc\nd\ne\nf"), (2, "x")]
    got = {(r["doc_id"], r["text"]) for r in drop_repeated_chunks(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == set(rows)  # the first place is in both repeated rows
    assert chunk_report(spark.createDataFrame([], DOCS)).collect() == []


def chunk_spans_of(text):
    """Chunks of two lines or more of every level: (first line, number)."""
    lines = text.split("\n")
    hashes = [xx(x.encode()) for x in lines]
    spans = {(at, 2) for at in range(len(lines) - 1)}
    for window, divisor in LEVELS:
        begin = 0
        for i in range(len(lines)):
            cut = i + 1 == len(lines)
            if i + 1 >= window:
                roll = 42
                for h in hashes[i + 1 - window : i + 1]:
                    roll = xx((h % (1 << 64)).to_bytes(8, "little"), roll % (1 << 64))
                cut |= roll % divisor == 0
            if cut:
                if i + 1 - begin >= 2:
                    spans.add((begin, i + 1 - begin))
                begin = i + 1
    return lines, spans


def brute_passages(rows):
    """The whole rule by definition: what is left of every text."""
    cut = {i: chunk_spans_of(t) for i, t in rows if t is not None}
    places = defaultdict(list)
    for i, (lines, spans) in cut.items():
        for at, n in spans:
            places[tuple(lines[at : at + n])].append((i, at))
    out = {i: t for i, t in rows}
    for i, (lines, spans) in cut.items():
        found = defaultdict(list)  # (own, earlier document, distance): hits
        for at, n in spans:
            mine = places[tuple(lines[at : at + n])]
            first = min(mine)
            if first[0] != i:
                found[False, first[0], at - first[1]].append((at, at + n))
            elif first[1] != at:
                found[True, None, at - max(p for d, p in mine if d == i and p < at)].append((at, at + n))
        grown = []
        for (own, source, shift), hits in found.items():
            runs = []
            for a, z in sorted(hits):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(z, runs[-1][1])
                else:
                    runs.append([a, z])
            for a, z in runs:
                a += own and shift == 1
                if not own:  # every line of a passage stands at the one earlier place
                    assert lines[a:z] == cut[source][0][a - shift : z - shift]
                if z - a >= 2:
                    grown.append((a - z, a, own, -1 if source is None else source, shift, z))
        owner = {k: min(p for p in grown if p[1] <= k < p[5]) for k in range(len(lines)) if any(p[1] <= k < p[5] for p in grown)}
        gone = set()
        for p in set(owner.values()):
            mine = [k for k in owner if owner[k] == p]
            if len(mine) >= 2 and sum(lines[k].strip(" ") != "" for k in range(min(mine), min(mine) + len(mine))) >= 2:
                gone |= set(range(min(mine), min(mine) + len(mine)))
        if gone:
            out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


@pytest.mark.parametrize("weak", [False, True])
def test_passages_between_own_lines(spark, tmp_dir, weak):
    """Passages of two to six lines go whole wherever they stand; own lines stay."""
    rnd = random.Random(9)
    passages = [[f"passage {p} line {k}" for k in range(2 + p % 5)] for p in range(25)]
    rows = [(p, "\n".join([f"first {p}", *x, f"last {p}"])) for p, x in enumerate(passages)]
    own = {}
    for i in range(100, 200):
        own[i] = [f"own {i} {k}" for k in range(4)]
        rows.append((i, "\n".join([*own[i][:2], *rnd.choice(passages), *own[i][2:]])))
    rows += [(i + 1000, t) for i, t in line_rows() if i < 7]
    rows += [(300, "x\nx\nx\nx"), (301, "y\nx\nx\nz"), (302, "solo"), (303, "solo"), (304, "solo\nother")]
    rows += [(400, "a\nb\nc\n" * 20 + "end"), (401, "p\nq\n" * 3), (402, "new\np\nq\nnew")]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    if weak:
        got = passage_report(df, hash_of=lambda c: F.unhex(F.lit("00"))).collect()
    else:
        df.write.parquet(f"{tmp_dir}/documents.parquet")
        got = op6_line_chunk_dedup(spark, tmp_dir).collect()
    left = {r["doc_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and left == brute_passages(rows)
    assert all(left[i] == "\n".join(x) for i, x in own.items())
    assert left[300] == "x\nx" and left[301] == "y\nz" and left[303] == "solo" and left[304] == "solo\nother"
    assert left[400] == "a\nb\nc\nend" and left[402] == "new\nnew"
    texts = dict(rows)
    for r in got:
        t = texts[r["doc_id"]]
        assert r["n_lines"] == (0 if t is None else len(t.split("\n")))
        assert r["n_chunks"] == (0 if t is None else len(brute_chunks(t))) and 0 <= r["n_removed"] <= r["n_lines"]
        assert r["removed_chars"] == (None if t is None else len(t) - len(r["text"]))


def test_lines_known_from_two_places_and_blank_lines(spark):
    """What never stood together before is not removed together; blank lines go with nothing."""
    rows = [(1, "A\nB\nown"), (2, "own 2\nB\nC"), (3, "A\nB\nC"), (4, "\n\nmine"), (5, "\n\nother"), (6, " \n\nlast"), (7, "x\n\ny"), (8, "z\nx\n\ny")]
    left = {r["doc_id"]: r["text"] for r in passage_report(spark.createDataFrame(rows, DOCS)).collect()}
    assert left == brute_passages(rows)
    assert left[3] == "C" and [left[i] for i in (1, 2, 4, 5, 6, 7)] == [t for i, t in rows if i in (1, 2, 4, 5, 6, 7)]
    assert left[8] == "z"


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("bound", [1 << 24, 0])  # repeated hashes broadcast, or texts joined by id
def test_passages_of_random_documents(spark, seed, bound):
    rnd = random.Random(seed)
    rows = [(None, "a\nb\nc"), (-3, "a\nb\nc\nd")]
    for i in range(120):
        lines = [rnd.choice(["a", "b", "c", "d", "", " "] if i % 3 else [f"l{k}" for k in range(25)]) for _ in range(rnd.randrange(1, 14))]
        rows.append((i, "\n".join(lines)))
    rows = [r for r in rows if r[0] is not None]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    got = {r["doc_id"]: r["text"] for r in passage_report(df, max_broadcast_bytes=bound).collect()}
    assert got == brute_passages(rows)


def test_null_ids_have_passages_too(spark):
    rows = [(None, "a\nb\nc"), (1, "x\na\nb\nc")]
    got = {r["doc_id"]: r["text"] for r in passage_report(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {None: "a\nb\nc", 1: "x"}


# ------------------------------------------------------------ tokens

def test_word_hashes_follow_words():
    texts = ["", "  ", "One two\tTHREE", "one two three", "Ünï çöde word", "a" * (PIECE + 10) + " tail", None]
    got = [h.tolist() for h in each_word_hashes([None if t is None else t.encode() for t in texts])]
    assert [len(h) for h in got] == [len(words(t)) for t in texts]
    assert got[2] == got[3]
    seen = {}
    for t, h in zip(texts, got):
        for w, x in zip(words(t), h):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)
    long = " ".join(f"w{k}" for k in range(400_000)).encode()
    assert len(np.unique(word_hashes(long))) == 400_000 and len(long) > 2 * PIECE
    assert len(shingles(word_hashes(b"a b c"))) == 1 and not len(shingles(word_hashes(b"")))


# ------------------------------------------------------------ components

def test_connected_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 640)]
    edges += [(1000, k) for k in range(1001, 1400)] + [(7, 7), (2000, 2000), (3, None)]
    whole = [e for e in edges if e[1] is not None]
    u = Union({x for e in whole for x in e})
    for a, b in whole:
        u.join(a, b)
    df = spark.createDataFrame(edges, "src long, dst long")
    assert {tuple(r) for r in connected_components(df).collect()} == {(n, u.find(n)) for n in u.up}
    names = spark.createDataFrame([("b", "c"), ("c", "a"), ("x", "y")], "src string, dst string")
    assert {tuple(r) for r in connected_components(names).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).collect() == []


# ------------------------------------------------------------ n-gram join

def join_rows():
    rnd = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    fresh = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    passage = fresh(60)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Alone"), (5, "alone"), (6, "a b c d"), (7, "a b c d e"), (8, "A B C D E")]
    n = 10
    for size in (8, 20, 60, 150, 260, 400, 900):
        for _ in range(6):
            base = fresh(size)
            rows.append((n, " ".join(base)))
            n += 1
            for share in (0.0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.08):
                copy = [rnd.choice(vocabulary) if rnd.random() < share else w for w in base]
                rows.append((n, " ".join(copy)))
                n += 1
    for _ in range(60):  # a common passage in otherwise different documents
        own = fresh(rnd.randint(5, 120))
        rows.append((n, " ".join(own[:3] + passage + own[3:])))
        n += 1
    base = fresh(100)
    for _ in range(80):  # a large group of near copies
        copy = list(base)
        copy[rnd.randrange(100)] = "x%d" % n
        rows.append((n, " ".join(copy)))
        n += 1
    rnd.shuffle(rows)
    return rows


def brute_links(rows):
    """id: (size of the set, component, links with other sets)."""
    sets = {i: frozenset(shingle_set(t)) for i, t in rows}
    u, links = Union(sets), {i: set() for i in sets}
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                u.join(a, b)
                if sets[a] != sets[b]:
                    links[a].add(sets[b])
                    links[b].add(sets[a])
    return {i: (len(sets[i]), u.find(i), len(links[i])) for i in sets}


def brute_components(rows):
    return {i: found[:2] for i, found in brute_links(rows).items()}


def test_shingle_components(spark):
    rows = join_rows()
    df = spark.createDataFrame(rows, DOCS).withColumn("rep", F.lit(1)).withColumn("token", F.lit("x")).repartition(6)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in shingle_components(df).collect()}
    assert got == brute_links(rows) and max(n for *_, n in got.values()) > 50


def test_small_tiles_find_the_same(spark, monkeypatch):
    import sievekit.llm.ngram_join as module

    monkeypatch.setattr(module, "TILE", 2_000)
    monkeypatch.setattr(module, "SLICE", 3_000)
    rows = join_rows()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in shingle_components(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == brute_links(rows)


def test_texts_sent_per_near_copy_stay_level(spark, monkeypatch):
    """A group of near copies of four times the size sends each text as often."""
    import sievekit.llm.ngram_join as module

    sent = []
    monkeypatch.setattr(module, "stage", lambda df, name: (lambda out: (sent.append(out.count()) if name == "join-work" else None, out)[1])(
        module.stage_table_of(df, name)))
    monkeypatch.setattr(module, "stage_table_of", stage, raising=False)
    rnd = random.Random(3)
    base = [rnd.choice([f"w{k}" for k in range(3000)]) for _ in range(120)]
    for size in (300, 1200):
        rows = []
        for i in range(size):
            copy = list(base)
            copy[rnd.randrange(120)] = f"x{i}"
            rows.append((i, " ".join(copy)))
        got = shingle_components(spark.createDataFrame(rows, DOCS)).collect()
        assert {r["component_id"] for r in got} == {0} and {r["n_links"] for r in got} == {size - 1}
    assert sent[1] / 1200 <= 1.2 * sent[0] / 300


def test_one_of_each(spark):
    rows = join_rows() + [(6, "a b c d"), (None, "without an id")]
    kept = one_of_each(spark.createDataFrame(rows, DOCS).withColumn("gone", F.lit(0)))
    want = brute_components(rows[:-1])
    assert kept.columns == ["doc_id", "text", "gone"]
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter([None, *(i for i, (_, c) in want.items() if i == c)])
    assert shingle_components(spark.createDataFrame([], DOCS)).collect() == []


def test_bounds():
    assert needed(4, THRESHOLD) == 3 and needed(192, THRESHOLD) == 144
    k = shared_at_least(128, THRESHOLD)
    assert needed(1000, THRESHOLD) == k and sum(math.comb(128, m) * 0.75**m * 0.25 ** (128 - m) for m in range(k)) <= 2**-64
    assert -(1 << 63) <= _class_of(b"\xff" * 16) < 1 << 63
    sets = [np.array(x, dtype=np.uint64) for x in ([1, 2, 3, 4], [1, 2, 3, 4, 5], [2, 3, 4, 5, 6], [9], [9])]
    home = np.arange(5)
    assert components_of(linked_pairs(sets, home), home).tolist() == [0, 0, 2, 3, 3]


@pytest.mark.parametrize("dense", [0, 1, 10**9])
def test_overlaps_of_all_pairs(monkeypatch, dense):
    import sievekit.llm.ngram_join as module

    monkeypatch.setattr(module, "DENSE", dense)
    monkeypatch.setattr(module, "COLUMNS", 3)
    monkeypatch.setattr(module, "PAIRS", 50)
    rnd = random.Random(4)
    for _ in range(30):
        sets = [np.unique(np.array([rnd.randrange(25) for _ in range(rnd.randrange(12))], dtype=np.uint64)) for _ in range(rnd.randrange(1, 20))]
        home = np.array(sorted(rnd.sample(range(len(sets)), rnd.randrange(len(sets) + 1))), dtype=np.int64)
        want = [[len(np.intersect1d(a, sets[h])) * (len(a) > 0) for h in home] for a in sets]
        got = overlaps(sets, home)
        shared = {(i, k) for i in range(len(sets)) for k in range(len(home)) if want[i][k] != got[i][k]}
        assert all(home[k] == i for i, k in shared)  # a set's shingles that no other has are left out
        linked = linked_pairs(sets, home)
        label = components_of(linked, home)
        u = Union(range(len(sets)))
        for i, k in zip(*np.nonzero(linked)):
            u.join(int(i), int(home[k]))
        assert label.tolist() == [u.find(i) for i in range(len(sets))]
