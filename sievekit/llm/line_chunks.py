"""Line deduplication over content-defined chunks of lines.

A hash rolling over ``window`` line hashes ends a chunk wherever it is 0
modulo ``divisor``, so boundaries depend only on nearby lines and survive
shifts. Chunks of at least two lines that occur more than once in the corpus
are hits; every hit but the first place (smallest id, then place) of its chunk
is compared byte by byte with it. ``chunk_report`` removes whole repeated
chunks and nothing else.

``passage_report`` finds the passages around the chunks. Chunks come from
several levels (``LEVELS``; the finest ends one after every line and takes two
neighbours, so that a passage of two lines is hit wherever it stands between a
document's own lines). Hits that point to one earlier document at one distance
grow together while they touch: the lines of such a passage stand at that
earlier place as a whole. A line that lies in several passages belongs to the
longest (then the first); a passage is removed if the lines that belong to it
are at least two with something in them. Repetitions within a document are
measured from the occurrence before, so of lines that repeat in turns the first
turn stays.

Only (id, place, 128-bit hash) rows are grouped; chunk texts travel for
repeated hashes only, reduced to distinct texts per task, so a passage that a
third of the documents carry is one row per task. DataFrame functions only.

Defined results
    null text        no lines, text stays null
    empty text       one empty line, never removed
    one line         that repeats without a neighbour stays
    blank lines      go with the passage that they stand in, never by themselves
    equal lines      in a row: the first two stay
    overlaps         A B and B C known from two places: of A B C, A B goes and C stays
    long texts       taken whole
    ties             the first place within the smallest id keeps the chunk
    repeated rows    rows with the same id and text share one fate: the first
                     place in them stays
    empty table      empty result
    extra columns    ignored by the reports, kept by ``drop_repeated_chunks``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievekit.llm.common import BROADCAST_BYTES, fresh, hinted, small, stage

WINDOW = 2
DIVISOR = 4
#: (window, divisor) of the levels above the finest
LEVELS = ((2, 2), (WINDOW, DIVISOR))
HIT_BYTES = 0  # memory that the hashes of repeated chunks may take as a hinted broadcast: none, so one plan serves every size
MIN_LINES = 2  # lines with something in them that a removed passage has


def chunk_ends(hashes: str, window: int, divisor: int) -> Column:
    """Where chunks end (line numbers from 1): the hash rolls over the lines
    that end at line i, and a boundary follows line i."""
    return F.filter(
        F.transform(hashes, lambda _, i: F.when(
            (i + 1 == F.size(hashes))
            | ((i + 1 >= window) & (F.pmod(F.xxhash64(F.slice(hashes, F.greatest(i + 2 - window, F.lit(1)), F.lit(window))),
                                           F.lit(divisor)) == 0)), i + 1)),
        lambda e: e.isNotNull())


def with_chunks(df: DataFrame, text_col: str = "_text", window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """Add ``_lines`` and ``_chunks`` (arrays of lines; null for a null text).

    In steps, so that the arrays are made once a row and not once a line."""
    df = df.withColumn("_lines", F.split(F.col(text_col), "\n", -1))
    df = df.withColumn("_hashes", F.transform("_lines", lambda x: F.xxhash64(x)))
    df = df.withColumn("_ends", chunk_ends("_hashes", window, divisor))
    begin = lambda k: F.when(k == 0, 0).otherwise(F.element_at("_ends", F.greatest(k, F.lit(1))))
    return df.withColumn("_chunks", F.transform("_ends", lambda e, k: F.slice("_lines", begin(k) + 1, e - begin(k)))).drop(
        "_hashes", "_ends")


def hash_128(chunk: Column) -> Column:
    return F.unhex(F.md5(chunk.cast("binary")))


def repeated_chunks(df: DataFrame, id_col: str, text_col: str, window: int = WINDOW, divisor: int = DIVISOR,
                    hash_of=hash_128, max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(id, gone): for documents that lose chunks, the places of the lost ones."""
    source = with_chunks(df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text", window, divisor)
    # the outer form: for the other, the optimizer adds a filter that makes the arrays anew for every line
    each = source.select("_id", F.posexplode_outer("_chunks").alias("_at", "_part")).filter(F.size("_part") >= 2).select(
        "_id", "_at", F.array_join("_part", "\n").alias("_chunk"))
    lost = lost_places(each, hash_of, max_broadcast_bytes)
    return lost.groupBy("_id").agg(F.collect_set("_at").alias("gone")).select(F.col("_id").alias(id_col), "gone")


def _between(ends: str) -> Column:
    """The chunks between their ends: first line (from 0) and length."""
    def span(end: Column, k: Column) -> Column:
        begin = F.when(k == 0, 0).otherwise(F.element_at(ends, F.greatest(k, F.lit(1))))
        return F.struct(begin.alias("at"), (end - begin).alias("len"))

    return F.transform(ends, span)


def chunk_spans(df: DataFrame, levels=LEVELS) -> DataFrame:
    """(_id, _at, _len, _chunk): every chunk of two lines or more of every level
    by its first line, length and text; one that several levels have comes once.

    In steps, so that the arrays are made once a row and not once a line."""
    df = df.withColumn("_hashes", F.transform("_lines", lambda x: F.xxhash64(x)))
    ends = {f"_ends{k}": chunk_ends("_hashes", *level) for k, level in enumerate(levels)}
    df = df.withColumns(ends)
    spans = [F.transform(F.slice("_hashes", 1, F.greatest(F.size("_hashes") - 1, F.lit(0))), lambda _, i: F.struct(i.alias("at"), F.lit(2).alias("len")))]
    spans += [F.filter(_between(name), lambda s: s["len"] > 2) for name in ends]  # those of two lines are there already
    df = df.withColumn("_spans", F.array_distinct(F.concat(*spans)))
    # the outer form: for the other, the optimizer adds a filter that makes the arrays anew for every line
    each = df.select("_id", "_lines", F.explode_outer("_spans").alias("_s")).filter("_s is not null")
    return each.select("_id", F.col("_s.at").alias("_at"), F.col("_s.len").alias("_len"),
                       F.array_join(F.slice("_lines", F.col("_s.at") + 1, F.col("_s.len")), "\n").alias("_chunk"))


def passages(df: DataFrame, id_col: str, text_col: str, levels=LEVELS, hash_of=hash_128,
             max_broadcast_bytes: int = HIT_BYTES) -> DataFrame:
    """(_id, spans): for documents with passages that stand at earlier places,
    the lines that belong to each (first line, number), whatever is in them."""
    source = df.select(F.col(id_col).alias("_id"), F.split(F.col(text_col), "\n", -1).alias("_lines"))
    lost = lost_places(chunk_spans(source, levels), hash_of, max_broadcast_bytes, "_len", source=source)
    # within a document, the distance is that from the occurrence before
    same = Window.partitionBy("_id", "_h").orderBy("_at")
    own = F.col("keeper._id").eqNullSafe(F.col("_id"))
    before = F.coalesce(F.lag("_at").over(same), F.col("keeper._at"))
    lost = lost.repartition("_id").select("_id", F.when(~own, F.col("keeper._id")).alias("_from"), own.alias("_own"), "_at",
                                          (F.col("_at") + F.col("_len")).alias("_end"),
                                          (F.col("_at") - F.when(own, before).otherwise(F.col("keeper._at"))).alias("_shift"))
    # all steps from here on stay in the partition of their document
    line = ["_id", "_own", "_from", "_shift"]
    ordered = Window.partitionBy(*line).orderBy("_at", "_end")
    reached = F.max("_end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    lost = lost.withColumn("_new", (F.coalesce(F.col("_at") > reached, F.lit(True))).cast("int"))
    lost = lost.withColumn("_nth", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    grown = lost.groupBy(*line, "_nth").agg(F.min("_at").alias("_at"), F.max("_end").alias("_end"))
    # of equal lines in a row, a second one is in the turn that stays
    grown = grown.withColumn("_at", F.col("_at") + F.when(F.col("_own") & (F.col("_shift") == 1), 1).otherwise(0)).filter(F.col("_end") - F.col("_at") >= 2)
    best = F.min(F.struct((F.col("_at") - F.col("_end")).alias("size"), F.col("_at").alias("at"), F.col("_own").alias("own"), F.col("_from").alias("from"),
                          F.col("_shift").alias("shift"))).alias("_best")
    lines = grown.select("*", F.explode(F.sequence(F.col("_at"), F.col("_end") - 1)).alias("_line")).groupBy("_id", "_line").agg(best)
    spans = lines.groupBy("_id", "_best").agg(F.min("_line").alias("at"), F.count(F.lit(1)).cast("int").alias("n")).filter(f"n >= {MIN_LINES}")
    return spans.groupBy("_id").agg(F.collect_list(F.struct("at", "n")).alias("spans"))


def lost_places(each: DataFrame, hash_of, max_broadcast_bytes: int, *carried: str, source: DataFrame | None = None) -> DataFrame:
    """(_h, _id, _at, carried columns, keeper) of every place whose ``_chunk``
    has an earlier place, the keeper.

    Chunk texts are compared where they were made if the repeated hashes may be
    broadcast. Else, with ``source`` (_id, _lines; chunks carry ``_len``), the
    places of repeated hashes are joined to their documents, so that a text
    moves once however many chunks it has."""
    each = each.select("_id", "_at", *carried, "_chunk", hash_of(F.col("_chunk")).alias("_h"))
    places = stage(each.select("_id", "_at", *carried, "_h"), "chunk-places")
    first = F.min(F.struct("_id", "_at")).alias("keeper")
    repeated = places.groupBy("_h").agg(F.count("*").alias("n"), first).filter("n > 1").select("_h", "keeper")
    repeated = stage(repeated, "chunk-repeated")

    if small(repeated, max_broadcast_bytes):
        suspects = each.join(F.broadcast(repeated.select("_h")), "_h", "left_semi")
    elif source is not None:
        hits = places.join(repeated.select("_h"), "_h", "left_semi").groupBy(F.col("_id").alias("_hit_id")).agg(
            F.collect_set(F.struct("_at", "_len", "_h")).alias("_hits"))  # of one document
        whole = source.join(hits, F.col("_id").eqNullSafe(F.col("_hit_id"))).select("_id", "_lines", F.explode("_hits").alias("_s"))
        suspects = whole.select("_id", "_s.*", F.array_join(F.slice("_lines", F.col("_s._at") + 1, F.col("_s._len")), "\n").alias("_chunk"))
        suspects = suspects.filter(hash_of(F.col("_chunk")) == F.col("_h"))  # another text of the same id has other chunks
    else:
        suspects = each.join(repeated.select("_h"), "_h", "left_semi")
    variants = suspects.groupBy("_h", "_chunk").agg(first)  # byte comparison
    collided = stage(variants.groupBy("_h").count().filter("count > 1").select("_h"), "chunk-collided")

    lost = places.join(hinted(repeated, max_broadcast_bytes), "_h")
    if not collided.isEmpty():
        hot = hinted(collided, max_broadcast_bytes)
        mixed = each.join(hot, "_h", "left_semi")
        exact = stage(mixed.groupBy("_h", "_chunk").agg(first), "chunk-variants")
        lost = lost.join(hot, "_h", "left_anti").unionByName(
            mixed.join(exact, ["_h", "_chunk"]).select("_h", "_id", "_at", *carried, "keeper"))
    return lost.filter(~F.struct("_id", "_at").eqNullSafe(F.col("keeper")))


def chunk_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 divisor: int = DIVISOR, **options) -> DataFrame:
    """One row per input row: id, n_lines, n_chunks, n_removed (chunks),
    removed_chars, text (what is left)."""
    gone = repeated_chunks(df, id_col, text_col, window, divisor, **options)
    gone = stage(gone.select(F.col(id_col).alias("_gone_id"), "gone"), "chunk-gone")
    base = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    joined = base.join(hinted(gone), F.col("_id").eqNullSafe(F.col("_gone_id")), "left")
    parts = with_chunks(joined, "_text", window, divisor)
    kept = F.filter("_chunks", lambda _, i: ~F.array_contains("gone", i))
    left = F.when(F.col("gone").isNull(), F.col("_text")).otherwise(F.array_join(F.flatten(kept), "\n"))
    out = parts.withColumn("text", left)
    return out.select(
        F.col("_id").alias(id_col), F.coalesce(F.size("_lines"), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("_chunks"), F.lit(0)).alias("n_chunks"), F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"),
        (F.length("_text") - F.length("text")).alias("removed_chars"), "text")


def passage_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", levels=LEVELS, **options) -> DataFrame:
    """One row per input row, without the passages of two lines or more that
    stand at an earlier place: id, n_lines, n_chunks (of the last level),
    n_removed (lines), removed_chars, text."""
    found = passages(df, id_col, text_col, levels, **options)
    found = stage(found.select(F.col("_id").alias("_gone_id"), "spans"), "passage-spans")
    base = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    joined = base.join(hinted(found), F.col("_id").eqNullSafe(F.col("_gone_id")), "left")
    # columns that a lambda reads are used twice or more, so that they are made once a row and not once a line
    rows = joined.withColumn("_lines", F.split("_text", "\n", -1)).withColumn("_hashes", F.transform("_lines", lambda x: F.xxhash64(x)))
    rows = rows.withColumn("_real", F.filter("spans", lambda s: F.size(F.filter(
        F.slice("_lines", s["at"] + 1, s["n"]), lambda x: F.trim(x) != "")) >= MIN_LINES))
    rows = rows.withColumn("_gone", F.flatten(F.transform("_real", lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1))))
    rows = rows.withColumn("_kept", F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.coalesce("_gone", F.array().cast("array<int>"))))
    rows = rows.withColumns({
        "text": F.when(F.coalesce(F.size("_gone"), F.lit(0)) <= 0, F.col("_text")).otherwise(
            F.array_join(F.transform("_kept", lambda i: F.element_at("_lines", i + 1)), "\n")),
        "n_lines": F.greatest(F.coalesce(F.size("_lines"), F.lit(0)), F.lit(0)),
        "n_chunks": F.greatest(F.coalesce(F.size(chunk_ends("_hashes", *levels[-1])), F.lit(0)), F.lit(0))})
    return rows.select(
        F.col("_id").alias(id_col), "n_lines", "n_chunks", F.greatest(F.coalesce(F.size("_gone"), F.lit(0)), F.lit(0)).alias("n_removed"),
        (F.length("_text") - F.length("text")).alias("removed_chars"), "text")


def drop_repeated_chunks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` with the lost chunks cut from its text column."""
    key, text = fresh(df, "left_id"), fresh(df, "left_text")
    report = chunk_report(df, id_col, text_col, **options).filter("n_removed > 0")
    left = report.select(F.col(id_col).alias(key), F.col("text").alias(text)).dropDuplicates([key])
    cut = df.join(left, df[id_col].eqNullSafe(left[key]), "left")
    return cut.select(*[(F.coalesce(left[text], df[c]).alias(c) if c == text_col else df[c]) for c in df.columns])
