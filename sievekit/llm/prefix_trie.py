"""The trie of conversation prefixes, as balanced parentheses per shard.

Every conversation c is rebuilt: the first h turns of conversation c - c % 5,
then its own turns after its first h (h = crc32 of c's digits, modulo 9). Each
distinct sequence of first d rebuilt turns is a node at depth d.

Identity of a prefix: a polynomial over the turns' 128-bit digests modulo the
prime 2**127 - 1. Polynomials of neighbouring pieces combine, so turns are put
into (conversation, turn) order by ranges and scanned piece by piece; a
conversation that lies in many pieces gets what the earlier ones add, and no
task holds a whole conversation.

Order: a node is known by (its smallest member m, its depth). Conversation m
leaves the path of a smaller conversation at some depth, that one of another,
and so on; the list of (depth, conversation), deeper departures first, sorts
all nodes in depth-first order. The list has as many entries as other
conversations branch off earlier, and those have at least as many turns as
the squares of it, so it stays below the square root of twice the rows.

Shards are ranges of that order. A shard writes its nodes as parentheses, with
range minima over blocks of their excess: ``findclose`` gives the end of a
subtree, the rank of leaf pairs "()" counts its leaves, a running sum its
savings. What a shard leaves open (its spine) is closed by the first later
shard whose smallest depth is low enough: shards pass on their minima, one row
each, and the steps at which their depth falls to a new minimum.

Defined results
    null conv_id           takes no part
    null role or text      empty
    equal turn numbers     in the order of role, then of the digest of (role, text)
    repeated rows          turns of their own
    negative conv_id       c % 5 takes the sign of c, as in SQL
    very long texts        move as digests and lengths
    empty table            no nodes, not even a root
    extra columns          ignored
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievekit.functions.skew import salted_lookup
from sievekit.llm.common import prepare_python, stage

PRIME = (1 << 127) - 1
POINT = int.from_bytes(hashlib.sha256(b"turn").digest()[:15], "big")  # where the polynomials are taken
HEAD = 8  # h is at most this
STRIDE, SPREAD = 5, 9  # the rule of rebuilding
BLOCK = 256  # parentheses of an excess block
DEPTHS = 4096  # depths that one group of requests to a shard spans
CHUNK_BITS = 10  # ends of a node are joined per 2**CHUNK_BITS neighbouring ids
ROOT = b"\0" * 16
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_SCANNED = "c long, part int, place long, f binary, size long, first boolean"


def head_turns(c: Column) -> Column:
    """h of a conversation."""
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(SPREAD)).cast("int")


def _value(b: bytes | None) -> int:
    return int.from_bytes(b, "big") if b else 0


def _bytes(v: int) -> bytes:
    return v.to_bytes(16, "big")


# ------------------------------------------------------- turns and their prefixes

def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and prefix polynomial of every row within its conversation's rows
    of this partition; ``first`` marks those of the partition's first conversation."""
    part = TaskContext.get().partitionId()
    now, place, acc, opening = None, 0, 0, None
    for b in batches:
        cs = b.column("c").to_pylist()
        places, polys, firsts = [], [], []
        for c, digest in zip(cs, b.column("digest").to_pylist(), strict=True):
            if c != now:
                now, place, acc = c, 0, 0
                opening = c if opening is None else opening
            place += 1
            acc = (acc * POINT + _value(digest)) % PRIME
            places.append(place)
            polys.append(_bytes(acc))
            firsts.append(c == opening)
        yield pa.record_batch([b.column("c"), pa.array([part] * len(cs), pa.int32()), pa.array(places, pa.int64()),
                               pa.array(polys, pa.binary()), b.column("size"), pa.array(firsts, pa.bool_())],
                              names=["c", "part", "place", "f", "size", "first"])


def _carried(carry: dict[int, tuple[int, int]]):
    """Adds to the first conversation of a partition what earlier ones hold of it."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places, polys = [], []
            for part, place, f in zip(*(b.column(n).to_pylist() for n in ("part", "place", "f")), strict=True):
                before, value = carry[part]
                polys.append(_bytes((value * pow(POINT, place, PRIME) + _value(f)) % PRIME))
                places.append(place + before)
            yield pa.record_batch([b.column("c"), pa.array(places, pa.int64()), pa.array(polys, pa.binary()), b.column("size")],
                                  names=["c", "pos", "f", "size"])

    return run


def turn_prefixes(conversations: DataFrame) -> DataFrame:
    """(c, pos, f, size): every turn's place in its conversation, the polynomial
    of the turns up to it and the bytes of its text."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), "turn", role.alias("role"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.octet_length(text).cast("long").alias("size"))
    keys = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    scanned = stage(turns.repartitionByRange(*keys).sortWithinPartitions(*keys).select("c", "digest", "size")
                    .mapInArrow(_scan, _SCANNED), "trie-turns")
    # conversations in several partitions: first in all but one of them, so at most one a partition
    spanning = scanned.filter("first").select("c").distinct()
    pieces = scanned.join(F.broadcast(spanning), "c").groupBy("part", "c").agg(
        F.max("place").alias("n"), F.max_by("f", "place").alias("f")).orderBy("part").collect()
    carry: dict[int, tuple[int, int]] = {}
    held: dict[int, tuple[int, int]] = {}
    for p in pieces:
        n, value = held.get(p["c"], (0, 0))
        if n:
            carry[p["part"]] = (n, value)
        held[p["c"]] = (n + p["n"], (value * pow(POINT, p["n"], PRIME) + _value(p["f"])) % PRIME)
    plain = scanned.select("c", F.col("place").alias("pos"), "f", "size")
    if not carry:
        return plain
    later = F.col("first") & F.col("part").isin(sorted(carry))
    return scanned.filter(~later).select(*plain.columns[:1], F.col("place").alias("pos"), "f", "size").unionByName(
        scanned.filter(later).mapInArrow(_carried(carry), "c long, pos long, f binary, size long"))


def _tail_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix identities of the turns after the first h: the own polynomial with
    the own head taken out and the other conversation's head put in."""
    for b in batches:
        out = []
        for f, k, ours, theirs in zip(*(b.column(n).to_pylist() for n in ("f", "k", "ours", "theirs")), strict=True):
            delta = _value(theirs) - _value(ours)
            out.append(_bytes((_value(f) + delta * pow(POINT, k, PRIME)) % PRIME if delta else _value(f)))
        yield pa.record_batch([b.column("c"), b.column("d"), pa.array(out, pa.binary()), b.column("size"), b.column("last")],
                              names=["c", "d", "id", "size", "last"])


def rebuilt_prefixes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, d, id, size, last) of every prefix of every rebuilt conversation, and
    (c, length) of all of them."""
    turns = turn_prefixes(conversations)
    h = head_turns(F.col("c"))
    counts = turns.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    convs = counts.select("c", "n", h.alias("h"), (F.col("c") - F.col("c") % STRIDE).alias("base"))
    head = turns.filter(F.col("pos") <= HEAD)
    theirs = head.filter(F.col("c") % STRIDE == 0).groupBy(F.col("c").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "f", "size"))).alias("head"))  # at most HEAD of them
    ours = head.filter(F.col("pos") == h).select("c", F.col("f").alias("ours"))
    info = convs.join(theirs, "base", "left").join(ours, "c", "left")
    info = info.withColumn("take", F.least("h", F.coalesce(F.size("head"), F.lit(0)))).withColumn(
        "take", F.greatest("take", F.lit(0)))
    info = info.withColumn("length", F.col("take") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    info = stage(info.select("c", "n", "h", "take", "length", "ours", F.slice("head", 1, F.col("take")).alias("head")), "trie-convs")
    heads = info.select("c", "length", F.explode("head").alias("t")).select(
        "c", F.col("t.pos").alias("d"), F.col("t.f").alias("id"), F.col("t.size").alias("size"),
        (F.col("t.pos") == F.col("length")).alias("last"))
    per = info.select("c", "h", "take", "length", "ours", F.try_element_at("head", F.lit(-1))["f"].alias("theirs"))
    tail = salted_lookup(turns.filter(F.col("pos") > h), per, ["c"], info.select("c", "n"), "n").select(
        "c", (F.col("pos") - F.col("h") + F.col("take")).alias("d"), "f", (F.col("pos") - F.col("h")).alias("k"), "ours", "theirs",
        "size", (F.col("pos") - F.col("h") + F.col("take") == F.col("length")).alias("last"))
    tail = tail.mapInArrow(_tail_ids, "c long, d long, id binary, size long, last boolean")
    return stage(heads.unionByName(tail), "trie-prefixes"), info.select("c", "length")


# ------------------------------------------------------- balanced parentheses

class Parentheses:
    """Nodes in depth-first order, given by their depths, as parentheses.

    The parenthesis of node i opens at bit 2 i + depth[0] - depth[i]; the
    excess there is its depth. What is open at the end stays open.
    """

    def __init__(self, depth: np.ndarray):
        self.depth = depth
        n = len(depth)
        self.opens = 2 * np.arange(n, dtype=np.int64) + depth[0] - depth if n else np.empty(0, np.int64)
        bits = np.zeros(int(self.opens[-1]) + 1 if n else 0, dtype=np.int8)
        bits[self.opens] = 1
        self.rank = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])  # opened before a bit
        self.excess = (2 * self.rank[1:] - np.arange(1, len(bits) + 1) + (depth[0] - 1 if n else 0)).astype(np.int64)
        self.levels = [self._minima(self.excess, BLOCK)] if n else []
        while self.levels and len(self.levels[-1]) > 1:
            self.levels.append(self._minima(self.levels[-1], 2))

    @staticmethod
    def _minima(values: np.ndarray, width: int) -> np.ndarray:
        return np.minimum.reduceat(values, np.arange(0, len(values), width))

    def findclose(self, node: int) -> int:
        """The first node after a node's subtree; the number of nodes if the
        subtree does not end here."""
        at, low = int(self.opens[node]) + 1, int(self.depth[node])
        end = min(len(self.excess), (at // BLOCK + 1) * BLOCK)
        hit = np.flatnonzero(self.excess[at:end] < low)
        if len(hit):
            return int(self.rank[at + hit[0]])
        block, level = at // BLOCK + 1, 0
        # up until a block to the right has a low enough minimum, then down to its first one
        while level < len(self.levels):
            row = self.levels[level]
            if block < len(row) and row[block] < low:
                break
            if block % 2 == 0 and block + 1 < len(row) and row[block + 1] < low:
                block += 1
                break
            block, level = block // 2 + 1, level + 1
        else:
            return len(self.depth)
        while level:
            level -= 1
            block *= 2
            if self.levels[level][block] >= low:
                block += 1
        start = block * BLOCK
        return int(self.rank[start + int((self.excess[start : start + BLOCK] < low).argmax())])

    def ends(self) -> np.ndarray:
        """``findclose`` of all nodes; a pair "()" ends at the next node."""
        n = len(self.depth)
        out = np.arange(1, n + 1)
        for i in np.flatnonzero(self.depth[1:] > self.depth[:-1]):
            out[i] = self.findclose(int(i))
        return out


_SHARD = ("part int, leaves long, saved long, closed boolean, step boolean, top long, leaves_before long, saved_before long")


def _shards(extra: list[str]):
    """Subtree sums within a shard, and the steps of its falling minima."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        depth = table.column("depth").to_numpy().astype(np.int64)
        if not len(depth):
            return
        n = len(depth)
        tree = Parentheses(depth)
        ends = tree.ends()
        leaf = np.concatenate([[0], np.cumsum(table.column("n_children").to_numpy() == 0)])
        saving = np.concatenate([[0], np.cumsum(table.column("saving").to_numpy().astype(np.int64))])
        index = np.arange(n)
        low = np.minimum.accumulate(depth)
        step = np.concatenate([[True], depth[1:] < low[:-1]])
        top = np.concatenate([[-1], low[:-1] - 1])
        closed = ends < n
        columns = [pa.array(np.full(n, TaskContext.get().partitionId(), dtype=np.int32)), pa.array(leaf[ends] - leaf[index]),
                   pa.array(saving[ends] - saving[index]), pa.array(closed), pa.array(step),
                   pa.array(np.where(top < 0, np.iinfo(np.int64).max, top)), pa.array(leaf[:-1]), pa.array(saving[:-1])]
        names = [s.split()[0] for s in _SHARD.split(", ")]
        whole = pa.table(columns + [table.column(c) for c in extra], names=names + extra)
        yield from whole.to_batches(max_chunksize=10_000)

    return run


def _closing(low: np.ndarray, leaves: np.ndarray, saved: np.ndarray):
    """For open nodes: the shard that closes them, and what lies between.
    ``low`` etc. hold smallest depth, leaves and savings of every shard."""
    leaf_sum, saved_sum = np.concatenate([[0], np.cumsum(leaves)]), np.concatenate([[0], np.cumsum(saved)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        falling: dict[int, np.ndarray] = {}
        for b in batches:
            parts, depth = b.column("part").to_numpy(), b.column("depth").to_numpy()
            target = np.empty(len(parts), dtype=np.int64)
            for k in np.unique(parts):
                if k not in falling:
                    falling = {k: -np.minimum.accumulate(low[k + 1 :]) if k + 1 < len(low) else np.empty(0, np.int64)}
                mine = parts == k
                target[mine] = k + 1 + np.searchsorted(falling[k], -depth[mine], side="left")
            add = [leaf_sum[target] - leaf_sum[parts + 1], saved_sum[target] - saved_sum[parts + 1]]
            replaced = {"leaves": b.column("leaves").to_numpy() + add[0], "saved": b.column("saved").to_numpy() + add[1]}
            names = b.schema.names
            yield pa.record_batch([pa.array(replaced[c]) if c in replaced else b.column(c) for c in names] + [pa.array(target)],
                                  names=[*names, "closer"])

    return run


# ------------------------------------------------------- the operator

def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash a node over its chunks of ids, in order, chunk by chunk."""
    now, sha = None, None
    for b in batches:
        out = []
        for node, ids in zip(b.column("id").to_pylist(), b.column("ids").to_pylist(), strict=True):
            if node != now:
                if now is not None:
                    out.append((now, sha.hexdigest()))
                now, sha = node, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if out:
            yield _digest_rows(out)
    if now is not None:
        yield _digest_rows([(now, sha.hexdigest())])


def _digest_rows(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())],
                           names=["id", "ends_sha256"])


def end_digests(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """(id, ends_sha256) of the nodes at which conversations end."""
    ends = prefixes.filter("last").select("id", "c").unionByName(
        convs.filter("length = 0").select(F.lit(bytearray(ROOT)).alias("id"), "c"))
    chunks = ends.groupBy("id", F.shiftright("c", CHUNK_BITS).alias("chunk")).agg(
        F.array_join(F.sort_array(F.collect_list("c")).cast("array<string>"), ",").alias("ids"))
    return chunks.repartition("id").sortWithinPartitions("id", "chunk").select("id", "ids").mapInArrow(
        _digests, "id binary, ends_sha256 string")


def _hex(c: Column) -> Column:
    return F.lpad(F.hex(c), 16, "0")


def branch_keys(prefixes: DataFrame, nodes: DataFrame, root_conv: int) -> DataFrame:
    """(conv_id, key, since, parent): for every conversation that is some
    node's smallest member, its sort key, the depth of its first own node and
    the conversation whose path it leaves there."""
    owners = nodes.select("id", F.col("conv_id").alias("m"), "n_convs")
    owned = salted_lookup(prefixes.select("c", "d", "id"), owners.drop("n_convs"), ["id"], owners, "n_convs")
    runs = owned.groupBy("c", "m").agg(F.min("d").alias("s")).filter(F.col("m") != F.lit(root_conv))
    runs = runs.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("s", "m"))).alias("runs"))
    runs = runs.filter(F.element_at("runs", -1)["m"] == F.col("c"))
    key = F.unhex(F.array_join(F.transform("runs", lambda r: F.concat(
        _hex(F.lit((1 << 62)) - r["s"]), _hex(r["m"].bitwiseXOR(F.lit(-(1 << 63)))))), ""))
    return runs.select(F.col("c").alias("conv_id"), key.alias("key"), F.element_at("runs", -1)["s"].alias("since"),
                       F.when(F.size("runs") > 1, F.try_element_at("runs", F.lit(-2))["m"]).otherwise(F.lit(root_conv)).alias("parent"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    prepare_python(spark)
    prefixes, convs = rebuilt_prefixes(conversations)
    whole = convs.agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).first()
    root = spark.range(1 if whole["n"] else 0).select(
        F.lit(bytearray(ROOT)).alias("id"), F.lit(whole["c"]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"),
        F.lit(whole["n"]).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("size"))
    nodes = prefixes.groupBy("id").agg(F.min("c").alias("conv_id"), F.min("d").alias("depth"),
                                       F.count(F.lit(1)).alias("n_convs"), F.min("size").alias("size"))
    nodes = stage(nodes.unionByName(root), "trie-nodes")
    root_conv = whole["c"] if whole["n"] else 0
    keys = stage(branch_keys(prefixes, nodes.filter("depth > 0"), root_conv), "trie-keys")
    hung = keys.groupBy(F.col("parent").alias("conv_id"), (F.col("since") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("hung"))
    per = keys.join(convs.withColumnRenamed("c", "conv_id"), "conv_id").unionByName(
        convs.filter(F.col("c") == F.lit(root_conv)).select(
            F.col("c").alias("conv_id"), F.lit(bytearray()).alias("key"), F.lit(0).cast("long").alias("since"),
            F.lit(None).cast("long").alias("parent"), "length"))
    rows = salted_lookup(nodes, per, ["conv_id"])
    rows = rows.join(end_digests(prefixes, convs), "id", "left").join(hung, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "n_convs", "key",
        F.when(F.col("depth") == F.col("since"), F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        (F.coalesce("hung", F.lit(0)) + (F.col("depth") < F.col("length")).cast("long")).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saving"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
    extra = [c for c in rows.columns if c != "key"]
    kinds = ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in extra)
    shards = stage(rows.repartitionByRange("key", "depth").sortWithinPartitions("key", "depth").select(*extra).mapInArrow(
        _shards(extra), f"{_SHARD}, {kinds}"), "trie-shards")
    return _merged(shards).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                                  F.col("saved").alias("saved_tokens"), "ends_sha256")


def _merged(shards: DataFrame) -> DataFrame:
    """Closes the spines: one row a shard tells which shard closes an open node,
    that shard's steps tell what of it still belongs to the node."""
    facts = shards.groupBy("part").agg(F.min("depth").alias("low"), F.max("depth").alias("high"),
                                       F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"),
                                       F.sum("saving").alias("saved")).collect()
    size = max((r["part"] for r in facts), default=-1) + 1
    low = np.full(size, np.iinfo(np.int64).max, dtype=np.int64)  # a partition without nodes closes nothing
    leaves, saved = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    for r in facts:
        low[r["part"]], leaves[r["part"]], saved[r["part"]] = r["low"], r["leaves"], r["saved"]
    deepest = max((r["high"] for r in facts), default=0)
    kinds = ", ".join(f"{n} {t}" for n, t in shards.dtypes)
    opened = shards.filter("not closed").mapInArrow(_closing(low, leaves, saved), f"{kinds}, closer long")
    opened = opened.withColumn("block", F.floor(F.col("depth") / DEPTHS).cast("long"))
    steps = shards.filter("step").select(
        F.col("part").cast("long").alias("closer"), F.col("depth").alias("from"), F.least("top", F.lit(deepest)).alias("to"),
        F.col("leaves_before").alias("more_leaves"), F.col("saved_before").alias("more_saved"))
    steps = steps.filter(F.col("from") <= F.col("to")).withColumn("block", F.explode(F.sequence(
        F.floor(F.col("from") / DEPTHS).cast("long"), F.floor(F.col("to") / DEPTHS).cast("long"))))
    closed = opened.alias("o").join(
        steps.alias("s"), (F.col("o.closer") == F.col("s.closer")) & (F.col("o.block") == F.col("s.block"))
        & F.col("o.depth").between(F.col("s.from"), F.col("s.to")), "left").select(
        *[F.col(f"o.{c}") for c in shards.columns if c not in ("leaves", "saved")],
        (F.col("o.leaves") + F.coalesce("s.more_leaves", F.lit(0))).alias("leaves"),
        (F.col("o.saved") + F.coalesce("s.more_saved", F.lit(0))).alias("saved"))
    return shards.filter("closed").unionByName(closed)
