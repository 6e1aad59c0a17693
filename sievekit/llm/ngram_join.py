"""N-gram Jaccard self-join with a token-group matrix.

Documents are sets of word shingles (64-bit hashes); two link when their
Jaccard similarity reaches ``threshold``. Steps:

1. Documents with the same set become one class; its smallest id stands for it.
2. Every class shows its ``sketch``: the whole set up to ``WHOLE`` shingles,
   else the ``SKETCH`` smallest hashes. Shingles are counted over all sketches
   (partial aggregation) and those of a single class are dropped. A class that
   shares too few of its sketch to have a partner is done. Of the others only
   the rarest shared shingles (the prefix) are kept: two linked classes must
   have one in common, however frequent the rest of their shingles are.
3. Classes are partitioned into groups of similar ones by their smallest
   shared shingle (min-hash); groups are cut into tiles of bounded size. The
   token-group matrix holds, for each prefix shingle, the groups whose token
   union has it. A query class meets only groups that the matrix names.
4. A tile is opened with its member classes and the query classes sent to it.
   Inside, the overlaps of all pairs with a member are counted at once, on whole
   sets from the whole texts: shingles that many sets have as a dense product,
   the others along their owners. Links come out as a spanning forest and as
   their number per class (every pair at one home), never as pairs.
5. Distributed connected components over the forests.

No cap on partners, groups or candidates. A sketch of ``SKETCH`` out of more
shingles misses a link with a probability below 2**-64, that of a 64-bit hash
collision (`shared_at_least`); up to ``WHOLE`` * threshold shingles the prefix
bound is exact.

Defined results
    null or empty text, no words   empty set, linked with nothing
    fewer than n words             one shingle, the whole sequence
    ties, repeated rows            same class, same component
    null id                        never stands for a class with an id
    very long texts                whole, hashed in pieces
    empty table                    empty result
    extra columns                  ignored by ``shingle_components``, kept by ``one_of_each``
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievekit.llm.common import fresh, hinted, prepare_python, small, stage, without_ids
from sievekit.llm.components import connected_components
from sievekit.llm.tokens import each_word_hashes, shingles

THRESHOLD = Fraction(3, 4)
NGRAM = 5
WHOLE = 256  # sets up to this size are their own sketch
SKETCH = 128  # shingles in the sketch of a larger set
TILE, TILE_SETS = 1_000_000, 2_000  # shingles and sets in a tile
SLICE, SLICE_SETS = 2_000_000, 4_000  # of the queries opened with a tile at once
COLUMNS = 1_024  # columns of a dense product
DENSE = 200  # one pair along owners costs as much as so many cells of a product
PAIRS = 2_000_000  # pairs along owners at once


def shared_at_least(k: int, threshold: Fraction) -> int:
    """The largest m such that of k random members of a union, fewer than m
    fall into the intersection with probability at most 2**-64, where the
    intersection holds ``threshold`` of the union."""
    p = float(threshold)
    total, m = 0.0, 0
    while m < k:
        total += math.comb(k, m) * p**m * (1 - p) ** (k - m)
        if total > 2.0**-64:
            break
        m += 1
    return max(1, m)


def needed(n: np.ndarray | int, threshold: Fraction) -> int:
    """Shingles that a class of n must share with a partner, within both sketches."""
    exact = -(-n * threshold.numerator // threshold.denominator)
    if n * threshold.denominator <= WHOLE * threshold.numerator:
        return exact  # any partner is its own sketch, too
    return min(exact, shared_at_least(SKETCH, threshold))


def _texts(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def _set_digests(n: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, digests = [], []
            for words in each_word_hashes(_texts(b, "_text")):
                s = shingles(words, n)
                sizes.append(len(s))
                digests.append(hashlib.md5(s.tobytes()).digest())
            yield pa.record_batch([b.column("_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())],
                                  names=["_id", "n", "set_hash"])

    return run


def _class_of(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


def _sketch_rows(n: int):
    """(token, cls): the sketch of the first member of each class in a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            tokens, owners, counts = [], [], []
            for words in each_word_hashes(_texts(b, "_text")):
                s = shingles(words, n)
                cls = _class_of(hashlib.md5(s.tobytes()).digest())
                if len(s) and cls not in seen:
                    seen.add(cls)
                    s = s if len(s) <= WHOLE else s[:SKETCH]
                    tokens.append(s)
                    owners.append(cls)
                    counts.append(len(s))
            if tokens:
                rows = np.repeat(np.array(owners, dtype=np.int64), counts)
                yield pa.record_batch([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(rows)], names=["token", "cls"])

    return run


def overlaps(sets: list[np.ndarray], home: np.ndarray) -> np.ndarray:
    """Shared shingles of every set with every home set, all pairs of a tile at once.

    Shingles that many sets have are columns of a dense product, the others
    are paired along their owners."""
    out = np.zeros((len(sets), len(home)), dtype=np.int32)
    flat = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, df = np.unique(flat, return_inverse=True, return_counts=True)
    shared = df[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    at_home = np.full(len(sets), -1)
    at_home[home] = np.arange(len(home))
    first = np.flatnonzero(np.diff(column, prepend=-1))
    count = np.diff(np.append(first, len(column)))
    dense = count.astype(np.int64) ** 2 * DENSE > out.size
    wide = np.flatnonzero(dense)
    for k in range(0, len(wide), COLUMNS):
        some = wide[k : k + COLUMNS]
        block = np.zeros((len(sets), len(some)), dtype=np.float32)
        for c, w in enumerate(some):
            block[owner[first[w] : first[w] + count[w]], c] = 1
        out += (block @ block[home].T).astype(np.int32)
    narrow = np.flatnonzero(~dense)
    pairs = count[narrow].astype(np.int64) ** 2
    piece = np.cumsum(pairs) // PAIRS
    for p in np.unique(piece):
        some = narrow[piece == p]
        left = np.repeat(count[some], count[some])  # every owner with every owner of its shingle
        begin = np.repeat(first[some], count[some])
        mine = begin + np.arange(len(begin)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
        a = np.repeat(owner[mine], left)
        z = owner[np.repeat(begin, left) + np.arange(left.sum()) - np.repeat(np.cumsum(left) - left, left)]
        kept = at_home[z] >= 0
        out += np.bincount(a[kept] * len(home) + at_home[z[kept]], minlength=out.size).reshape(out.shape).astype(np.int32)
    return out


def linked_pairs(sets: list[np.ndarray], home: np.ndarray, threshold: Fraction = THRESHOLD) -> np.ndarray:
    """Which sets link with which home sets; none with itself."""
    size = np.array([len(x) for x in sets], dtype=np.int64)
    num, den = threshold.numerator, threshold.denominator
    shared = overlaps(sets, home)
    out = (shared > 0) & (shared * (num + den) >= num * (size[:, None] + size[home][None, :]))
    out[home, np.arange(len(home))] = False
    return out


def components_of(linked: np.ndarray, home: np.ndarray) -> np.ndarray:
    """For each set, the position of the first set of its component."""
    label = np.arange(len(linked))
    far = len(linked)
    while True:
        new = label.copy()
        if linked.size:
            below = np.where(linked, label[:, None], far).min(axis=0)
            new[home] = np.minimum(new[home], below)
            new = np.minimum(new, np.where(linked, new[home][None, :], far).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _open_tile(n: int, threshold: Fraction):
    """Links of one tile: a spanning forest (src, dst), and per class the number
    of its links (``n_links``, dst null), every pair counted at one home."""
    def run(group: pa.Table) -> pa.Table:
        reps, first = np.unique(group.column("rep").to_numpy(), return_index=True)
        texts = group.column("_text").cast(pa.binary())
        member = group.column("home").to_numpy()[first]
        sets = [shingles(w, n) for w in each_word_hashes(texts[int(i)].as_py() for i in first)]
        home = np.flatnonzero(member)
        linked = linked_pairs(sets, home, threshold)
        root = components_of(linked, home)
        hangs = root != np.arange(len(root))
        counted = linked.copy()
        if len(group) and group.column("slice")[0].as_py():  # home pairs meet in every slice and count in the first
            counted[home] = False
        links = counted.sum(axis=1)
        links[home] += counted[~member].sum(axis=0)
        some = links > 0
        src = np.concatenate([reps[hangs], reps[some]])
        dst = pa.array(np.concatenate([reps[root[hangs]], np.zeros(some.sum(), dtype=np.int64)]),
                       mask=np.concatenate([np.zeros(hangs.sum(), dtype=bool), np.ones(some.sum(), dtype=bool)]))
        return pa.table({"src": src, "dst": dst, "n_links": np.concatenate([np.zeros(hangs.sum(), dtype=np.int64), links[some]])})

    return run


def shingle_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM,
                       threshold: Fraction = THRESHOLD) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, n_links (linked
    documents of other sets; of those with one set, one is counted)."""
    prepare_python(df.sparkSession)
    texts = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    rows = stage(texts.mapInArrow(_set_digests(n), "_id long, n long, set_hash binary"), "join-rows")
    classes = rows.filter("n > 0 and _id is not null").groupBy("set_hash").agg(
        F.min("_id").alias("rep"), F.min("n").alias("n"), F.count("*").alias("copies"))
    cls = F.conv(F.hex(F.substring("set_hash", 1, 8)), 16, -10).cast("long")
    classes = stage(classes.withColumn("cls", cls), "join-classes")
    links = _links(texts, rows, classes, n, threshold)
    counts = links.filter("dst is null").groupBy(F.col("src").alias("counted")).agg(F.sum("n_links").alias("n_links"))

    # copies take their class's first id, and that the smallest id of its component
    many = hinted(classes.filter("copies > 1").select("set_hash", "rep"))
    reached = connected_components(links.filter("dst is not null").select("src", "dst"))
    reached = hinted(stage(reached.join(counts, reached["node"] == counts["counted"], "left").drop("counted"), "join-components"))
    out = rows.join(many, "set_hash", "left").withColumn("rep", F.coalesce("rep", "_id"))
    out = out.join(reached, out["rep"] == reached["node"], "left")
    return out.select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("_id")).otherwise(F.coalesce("component", "rep")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def _links(texts: DataFrame, rows: DataFrame, classes: DataFrame, n: int, threshold: Fraction) -> DataFrame:
    """Over class representatives: a spanning forest (src, dst) of the links, and
    the number of links (src, n_links; dst null), staged."""
    spark = texts.sparkSession
    copies = stage(rows.join(hinted(classes.filter("copies > 1").select("set_hash", "rep")), "set_hash")
                   .filter("_id <> rep").select("_id").distinct(), "join-copies")
    # copies add nothing to the sketches; if too many to broadcast they only cost time
    singles = texts.join(F.broadcast(copies), "_id", "left_anti") if small(copies) else texts
    sketches = singles.select("_text").mapInArrow(_sketch_rows(n), "token long, cls long")
    shared = stage(sketches.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"), "join-shared")

    limits = spark.createDataFrame([(i, needed(i, threshold)) for i in range(1, WHOLE + 2)], "size int, needed int")
    shown = sketches.join(shared, "token").groupBy("cls").agg(
        F.array_sort(F.collect_set(F.struct("df", "token"))).alias("tokens"))
    shown = shown.join(classes.select("cls", "rep", "n"), "cls").withColumn("size", F.least("n", F.lit(WHOLE + 1)).cast("int"))
    shown = shown.join(F.broadcast(limits), "size").filter(F.size("tokens") >= F.col("needed"))
    members = stage(shown.select(
        "rep", "n", F.array_min(F.transform("tokens", lambda t: t["token"])).alias("grp"),
        F.transform(F.slice("tokens", 1, F.size("tokens") - F.col("needed") + 1), lambda t: t["token"]).alias("prefix"),
    ), "join-members")

    # the token-group matrix, and the groups that each class has to ask
    tokens = members.select("rep", "n", "grp", F.explode("prefix").alias("token"))
    matrix = tokens.select("token", F.col("grp").alias("to")).distinct()
    asked = tokens.join(matrix, "token").filter("to >= grp").select("rep", "n", "grp", "to").distinct()
    asked = stage(asked.unionByName(members.select("rep", "n", "grp", F.col("grp").alias("to"))).distinct(), "join-asked")

    # tiles of a group, and slices of the queries sent to it
    parts = lambda size, sets: F.ceil(F.greatest(F.sum("n") / size, F.count(F.lit(1)) / sets)).cast("int")
    own = members.groupBy("grp").agg(parts(TILE, TILE_SETS).alias("tiles"))
    load = asked.groupBy(F.col("to").alias("grp")).agg(parts(SLICE, SLICE_SETS).alias("slices"), F.count("*").alias("asking"))
    layout = stage(own.join(load, "grp").filter("asking > 1").select("grp", "tiles", "slices"), "join-layout")
    spread = F.pmod(F.xxhash64("rep"), F.lit(1 << 30))
    placed = asked.join(layout.withColumnRenamed("grp", "to"), "to").withColumn("tile", (spread % F.col("tiles")).cast("int"))
    spots = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(
        t.alias("tile"), F.col("_slice").alias("slice")))
    placed = placed.withColumn("_slice", (F.pmod(F.xxhash64("rep", F.lit(7)), F.lit(1 << 30)) % F.col("slices")).cast("int"))
    # a member goes to its tile, once for each slice of queries; a query to every tile of the group, in its slice
    home = placed.filter("grp = to").select("rep", "to", F.col("tile"), F.explode(
        F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(True).alias("home"))
    asks = placed.select("rep", "to", F.explode(spots).alias("s"), "tile", "grp").filter(
        "grp <> to or s.tile > tile").select("rep", "to", "s.tile", "s.slice", F.lit(False).alias("home"))
    work = home.unionByName(asks)
    alone = Window.partitionBy("to", "tile", "slice")
    work = stage(work.withColumn("_k", F.count("*").over(alone)).filter("_k > 1").drop("_k"), "join-work")

    opened = texts.join(hinted(work), texts["_id"] == work["rep"]).select("rep", "to", "tile", "slice", "home", "_text").groupBy(
        "to", "tile", "slice").applyInArrow(_open_tile(n, threshold), "src long, dst long, n_links long")
    return stage(opened, "join-links")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM,
                threshold: Fraction = THRESHOLD) -> DataFrame:
    """``df`` without the documents whose component has a smaller id; rows that
    repeat a kept id and text are one document and stay once."""
    found = stage(shingle_components(df, id_col, text_col, n, threshold), "join-result")
    kept = without_ids(df, id_col, found.filter(F.col(id_col) != F.col("component_id")).select(id_col), "join-gone")
    twice = stage(found.filter(F.col("n_shingles") > 0).groupBy(id_col).count().filter("count > 1").select(id_col), "join-twice")
    if twice.isEmpty():
        return kept
    again = twice.toDF(fresh(df, "again"))
    alone = kept.join(hinted(again), kept[id_col] == again[again.columns[0]], "left_anti")
    repeated = kept.join(hinted(again), kept[id_col] == again[again.columns[0]], "left_semi")
    return alone.unionByName(repeated.dropDuplicates([id_col, text_col]))
