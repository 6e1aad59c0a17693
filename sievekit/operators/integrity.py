"""Referential integrity (J1-J8): foreign keys absent from a reference column.

All rules of a target are counted by ONE tagged union: a single scan of the
target emits (rule, key, one row), every reference table emits (rule, key,
mark), and one grouped sum and maximum over both gives, for every rule and
key, how many rows use it and whether the reference has it. Counts, samples and
orphan keys all come from that table. Nothing is joined by a shuffle; a key that
holds a third of the target is one row per map task (partial aggregation), and
the one exchange moves distinct keys only. References under the size bound are
looked up within the same scan (a broadcast), so that only missing keys go on.

Violating rows (J5/J6) need whole rows: one scan of the target for all rules
whose reference keys, or whose orphan keys, are few enough to be broadcast; a
shuffle anti join (split by AQE at hot keys) for the rest.

A null FK is a violation; ``nulls="ignore"`` drops null FKs first. A null
reference key matches nothing. Keys of two types are compared, and counted, in
their common type.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sievekit.functions.sizing import ROW_BYTES, broadcast_limit, is_small
from sievekit.session import stage_table

Resolver = Callable[[SparkSession, str | None, str], DataFrame]


def catalog_resolver(spark: SparkSession, database: str | None, table: str) -> DataFrame:
    """Default: ``spark.table(database.table)``."""
    return spark.table(f"{database}.{table}" if database else table)


def mapping_resolver(tables: Mapping[str, DataFrame]) -> Resolver:
    """Resolve reference tables from a name -> DataFrame mapping (db ignored)."""
    def resolve(_spark, database, table):
        key = f"{database}.{table}" if database and f"{database}.{table}" in tables else table
        if key not in tables:
            raise LookupError(f"reference table not found: {table}")
        return tables[key]
    return resolve


def _prepare(target: DataFrame, rules: Sequence[Mapping], resolve: Resolver | None):
    """Yield (idx, rule, fk, ref_df, ref_col, error_status, message) per rule."""
    resolve = resolve or catalog_resolver
    spark = target.sparkSession
    for idx, rule in enumerate(rules or []):
        fk = rule.get("foreign_key")
        table, database = rule.get("reference_table"), rule.get("database")
        ref_col = rule.get("reference_column")
        ref_name = f"{database}.{table}" if database else str(table)
        if fk not in target.columns:
            yield idx, rule, fk, None, ref_col, "missing_column", f"Column '{fk}' not found in target table"
            continue
        try:
            ref = resolve(spark, database, table)
        except Exception as exc:  # noqa: BLE001 - report, keep checking other rules
            yield idx, rule, fk, None, ref_col, "missing_reference_table", f"Reference table '{ref_name}' not found or unreadable: {type(exc).__name__}"
            continue
        if ref_col not in ref.columns:
            yield idx, rule, fk, None, ref_col, "missing_reference_column", f"Column '{ref_col}' not found in reference table '{ref_name}'"
            continue
        fk_type, ref_type = (d.schema[c].dataType for d, c in ((target, fk), (ref, ref_col)))
        if not _comparable(fk_type, ref_type):
            yield idx, rule, fk, None, ref_col, "type_mismatch", f"Column '{fk}' ({fk_type.simpleString()}) does not compare with '{ref_col}' ({ref_type.simpleString()})"
            continue
        if isinstance(fk_type, T.StringType) and not isinstance(ref_type, T.StringType):
            # rule files are all text: compare as text, a cast of the text could fail
            ref = ref.select(F.col(f"`{ref_col}`").cast("string").alias(ref_col))
        elif isinstance(ref_type, T.StringType) and not isinstance(fk_type, T.StringType):
            # text that is no such value matches nothing
            ref = ref.select(F.col(f"`{ref_col}`").try_cast(fk_type).alias(ref_col))
        yield idx, rule, fk, ref, ref_col, None, None


def _comparable(a: T.DataType, b: T.DataType) -> bool:
    """Whether two key types compare: alike, both numbers, both times, or one is text."""
    families = (T.NumericType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    return type(a) is type(b) or any(isinstance(a, f) and isinstance(b, f) for f in families) or (
        isinstance(a, T.StringType) != isinstance(b, T.StringType) and all(isinstance(x, T.AtomicType) for x in (a, b)))


def _ref_keys(ref: DataFrame, ref_col: str, max_broadcast_bytes: int | None) -> tuple[DataFrame, bool]:
    """The reference key column, broadcast when its estimated size is bounded."""
    keys = ref.select(F.col(f"`{ref_col}`").alias("__ref_key"))
    if is_small(keys, max_broadcast_bytes):
        return F.broadcast(keys), True
    return keys, False


def _target(target: DataFrame, fk: str, nulls: str) -> DataFrame:
    if nulls == "ignore":
        return target.filter(F.col(f"`{fk}`").isNotNull())
    if nulls != "fail":
        raise ValueError("nulls must be 'fail' or 'ignore'")
    return target


@dataclass(frozen=True)
class _Check:
    """A foreign key that can be checked."""

    idx: int
    fk: str
    ref: DataFrame
    ref_col: str
    kind: str  # common type of both columns


def _checks(target: DataFrame, prepared: Sequence[tuple]) -> list[_Check]:
    out = []
    for idx, _rule, fk, ref, ref_col, err, _msg in prepared:
        if err is None:
            a, b = (F.lit(None).cast(d.schema[c].dataType) for d, c in ((target, fk), (ref, ref_col)))
            common = target.sparkSession.range(0).select(F.coalesce(a, b).alias("k")).schema["k"].dataType
            out.append(_Check(idx, fk, ref, ref_col, common.simpleString()))
    return out


def _key_columns(checks: Sequence[_Check]) -> dict[str, str]:
    """One key column of the tagged table per key type."""
    return {kind: f"__k{i}" for i, kind in enumerate(dict.fromkeys(c.kind for c in checks))}


def _tagged(df: DataFrame, checks: Sequence[_Check], columns: Sequence[str], keys: Mapping[str, str], nulls: bool,
            without: Mapping[int, Column]) -> DataFrame:
    """A row per row and check: (rule_idx, key in the column of its type), but
    for the rows that a check is said to be without."""
    cells = []
    for c, column in zip(checks, columns, strict=True):
        cells.append(F.when(~without[c.idx], F.lit(c.idx)) if c.idx in without else F.lit(c.idx))
        cells += [(F.col(f"`{column}`") if kind == c.kind else F.lit(None)).cast(kind) for kind in keys]
    names = ["rule_idx", *keys.values()]
    out = df.select(F.stack(F.lit(len(checks)), *cells).alias(*names))
    out = out.filter(F.col("rule_idx").isNotNull()) if without else out
    return out if nulls else out.filter(reduce(Column.__or__, [F.col(k).isNotNull() for k in keys.values()]))


def _orphans(target: DataFrame, checks: Sequence[_Check], nulls: str, max_broadcast_bytes: int | None = None, slices: int = 1) -> DataFrame:
    """(rule_idx, key columns, n_rows): the keys of the target that no reference has.

    Keys of references small enough to be broadcast are looked up within the
    scan, and only rows that miss go on; the other references are in the union.
    With ``slices``, the one in so many keys that a hash picks on both sides."""
    if nulls not in ("fail", "ignore"):
        raise ValueError("nulls must be 'fail' or 'ignore'")
    keys = _key_columns(checks)
    known = {c.idx: _ref_keys(c.ref, c.ref_col, max_broadcast_bytes) for c in checks}
    near = [(c.idx, c.fk, known[c.idx][0]) for c in checks if known[c.idx][1]]
    rows, misses = _flag_misses(target.select(*[F.col(f"`{fk}`") for fk in dict.fromkeys(c.fk for c in checks)]), near, [], nulls)
    hits = {idx: ~miss for idx, _fk, miss in misses}
    if len(near) == len(checks):  # rows that miss nothing are none of the rest's business
        rows = rows.filter(reduce(Column.__or__, [miss for _idx, _fk, miss in misses]))
    parts = [_tagged(rows, checks, [c.fk for c in checks], keys, nulls == "fail", hits).select(
        "*", F.lit(1).cast("long").alias("n_rows"), F.lit(False).alias("__known"))]
    by_reference: dict[int, list[_Check]] = {}  # a reference table of several rules is read once
    for c in checks:
        if not known[c.idx][1]:
            by_reference.setdefault(id(c.ref), []).append(c)
    for same in by_reference.values():
        parts.append(_tagged(same[0].ref, same, [c.ref_col for c in same], keys, False, {}).select(
            "*", F.lit(0).cast("long").alias("n_rows"), F.lit(True).alias("__known")))
    tagged = reduce(DataFrame.unionByName, parts)
    if slices > 1:
        tagged = tagged.filter(F.pmod(F.xxhash64(*keys.values()), F.lit(slices)) == 0)
    grouped = tagged.groupBy("rule_idx", *keys.values()).agg(
        F.sum("n_rows").alias("n_rows"), F.bool_or("__known").alias("__known"))
    return grouped.filter(~F.col("__known")).drop("__known")


def _flag_misses(target: DataFrame, small: list, orphans: list, nulls: str) -> tuple[DataFrame, list]:
    """Chain one map-side broadcast left join per rule: ``small`` rules join
    their reference keys, ``orphans`` rules the few keys that miss.

    Returns the target with the flags and, per rule, a Column that is true
    when the row's FK has no reference match. Keys are de-duplicated first so
    the left joins never multiply rows.
    """
    t = target
    misses = []
    for idx, fk, keys in small:
        hit = f"__hit{idx}"
        k = F.broadcast(keys.filter(F.col("__ref_key").isNotNull()).distinct().withColumn(hit, F.lit(True)))
        t = t.join(k, t[f"`{fk}`"] == k["__ref_key"], "left").drop("__ref_key")
        miss = F.col(hit).isNull()
        if nulls == "ignore":
            miss = miss & F.col(f"`{fk}`").isNotNull()
        misses.append((idx, fk, miss))
    for idx, fk, keys in orphans:
        hit = f"__miss{idx}"
        k = F.broadcast(keys.withColumn(hit, F.lit(True)))
        t = t.join(k, t[f"`{fk}`"].eqNullSafe(k["__orphan"]), "left").drop("__orphan")
        misses.append((idx, fk, F.col(hit).isNotNull()))
    return t, misses


SLICES = 64  # orphans of one in so many keys are counted before those of all
ENOUGH = 100  # orphan keys in that slice, at least, to forecast from


def _orphan_sizes(orphans: DataFrame, checks: Sequence[_Check]) -> dict[int, tuple[int, int]]:
    """Per rule: how many orphan keys, and the bytes of memory they take."""
    width = reduce(Column.__add__, [F.coalesce(F.octet_length(k) if kind == "string" else F.lit(16), F.lit(0)) for kind, k in _key_columns(checks).items()])
    sizes = orphans.groupBy("rule_idx").agg(F.count(F.lit(1)).alias("n"), F.sum(width + ROW_BYTES).alias("bytes"))
    return {r["rule_idx"]: (r["n"], r["bytes"]) for r in sizes.collect()}


def _few_orphans(target: DataFrame, large: list, nulls: str, max_bytes: int) -> dict[int, DataFrame]:
    """Per rule its orphan keys (``__orphan``), for the rules whose orphan keys
    are counted to take at most ``max_bytes`` of memory; staged.

    The count groups every key of the target, in vain where the orphans are
    many. So a slice of the keys is counted first: a rule with enough orphans
    in it to forecast too many has no full count. The slice only decides how
    a rule's rows are found; all of them are found either way."""
    checks = _checks(target, [(idx, rule, fk, ref, ref_col, None, None) for idx, fk, _keys, rule, ref, ref_col in large])
    part = _orphan_sizes(_orphans(target, checks, nulls, 0, SLICES), checks)
    many = {idx for idx, (n, size) in part.items() if n >= ENOUGH and size * SLICES > max_bytes}
    checks = [c for c in checks if c.idx not in many]
    if not checks:
        return {}
    found = stage_table(_orphans(target, checks, nulls, 0), "fk-orphans")
    keys, sizes = _key_columns(checks), _orphan_sizes(found, checks)
    return {c.idx: found.filter(F.col("rule_idx") == c.idx).select(F.col(keys[c.kind]).alias("__orphan"))
            for c in checks if sizes.get(c.idx, (0, 0))[1] <= max_bytes}


def _split_rules(target, rules, resolve, max_broadcast_bytes, only_logged=False):
    """(small, large, errors): small rules have size-checked broadcast keys."""
    small, large, errors = [], [], []
    for idx, rule, fk, ref, ref_col, err, msg in _prepare(target, rules, resolve):
        if err is not None:
            errors.append((idx, rule, fk, ref_col, err, msg))
            continue
        if only_logged and rule.get("action", "log") != "log":
            continue
        keys, broadcast = _ref_keys(ref, ref_col, max_broadcast_bytes)
        (small if broadcast else large).append((idx, fk, keys, rule, ref, ref_col))
    return small, large, errors


def fk_report(
    target: DataFrame,
    rules: Sequence[Mapping],
    resolve: Resolver | None = None,
    *,
    nulls: str = "fail",
    max_broadcast_bytes: int | None = None,
) -> DataFrame:
    """One row per rule with violation counts or an error status.

    One scan of the target and one exchange of distinct keys, whatever the
    number of rules; the totals of all rules are one row.
    """
    prepared = list(_prepare(target, rules, resolve))
    checks = _checks(target, prepared)
    totals = target.sparkSession.range(1)
    if checks:
        mine = {c.idx: F.col("rule_idx") == c.idx for c in checks}
        totals = _orphans(target, checks, nulls, max_broadcast_bytes).agg(
            *[F.coalesce(F.sum(F.when(m, F.col("n_rows"))), F.lit(0)).cast("long").alias(f"__v{i}") for i, m in mine.items()],
            *[F.count_if(m).alias(f"__o{i}") for i, m in mine.items()])
    rows = []
    for idx, rule, fk, _ref, ref_col, err, msg in prepared:
        ref_name = ".".join(str(x) for x in (rule.get("database"), rule.get("reference_table"), ref_col) if x)
        if err is None:
            violations, orphan_keys = F.col(f"__v{idx}"), F.col(f"__o{idx}")
            status = F.when(violations == 0, F.lit("pass")).otherwise(F.lit("fail"))
            message = F.concat(F.lit(f"{fk} -> {ref_name}: "), violations.cast("string"), F.lit(" violation(s)"))
        else:
            violations = orphan_keys = F.lit(None).cast("long")
            status, message = F.lit(err), F.lit(msg)
        rows.append(F.struct(
            F.lit(idx).alias("rule_idx"), F.lit(fk).cast("string").alias("foreign_key"), F.lit(ref_name).alias("reference"),
            F.lit(rule.get("action", "log")).alias("action"), status.alias("status"), violations.alias("n_violations"),
            orphan_keys.alias("n_orphan_keys"), message.alias("message")))
    if not rows:
        return target.sparkSession.createDataFrame(
            [], "rule_idx int, foreign_key string, reference string, action string, status string, "
                "n_violations long, n_orphan_keys long, message string")
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def fk_verdict(report: DataFrame) -> DataFrame:
    """All rules passed; False when there are no rules (as the reference)."""
    return report.agg(
        (F.coalesce(F.bool_and(F.col("status") == "pass"), F.lit(False))).alias("all_passed"),
        F.count(F.lit(1)).alias("n_rules"),
        F.count_if(F.col("status") != "pass").alias("n_failed"))


def fk_violations(
    target: DataFrame,
    rules: Sequence[Mapping],
    resolve: Resolver | None = None,
    *,
    nulls: str = "fail",
    max_broadcast_bytes: int | None = None,
    only_logged: bool = True,
) -> DataFrame:
    """Violating target rows tagged with ``failed_fk``, all rules unioned.

    A row failing two rules appears twice (UNION ALL), as in the reference.
    Rules whose ``action`` is not ``log`` are counted by ``fk_report`` but not
    emitted here unless ``only_logged=False``.

    Rules whose reference keys pass the size check share ONE scan of the
    target: each adds a map-side broadcast left join against its de-duplicated
    keys (a hit flag), and the failed rule names are exploded once. So do rules
    with large references whose orphan keys are few: those are found first (one
    more scan, of the key columns) and counted before they are broadcast. Rules
    with many orphan keys get a shuffle anti join of their own; a slice of the
    keys tells them apart (a scan of the key columns too) before all are grouped.
    """
    if nulls not in ("fail", "ignore"):
        raise ValueError("nulls must be 'fail' or 'ignore'")
    small, large, _errors = _split_rules(target, rules, resolve, max_broadcast_bytes, only_logged=only_logged)
    limit = broadcast_limit(target.sparkSession, max_broadcast_bytes)
    few = _few_orphans(target, large, nulls, limit) if large and limit > 0 else {}
    parts = []
    if small or few:
        cols = [F.col(f"`{c}`") for c in target.columns]
        t, misses = _flag_misses(target, [(i, fk, k) for i, fk, k, *_ in small],
                                 [(i, fk, few[i]) for i, fk, *_ in large if i in few], nulls)
        failed = [F.when(miss, F.lit(fk)) for _idx, fk, miss in misses]
        parts.append(t.select(*cols, F.explode(F.array(*failed)).alias("failed_fk"))
                     .filter(F.col("failed_fk").isNotNull()))
    for idx, fk, keys, *_rest in large:
        if idx in few:
            continue
        tt = _target(target, fk, nulls)
        v = tt.join(keys, tt[f"`{fk}`"] == keys["__ref_key"], "left_anti")
        parts.append(v.withColumn("failed_fk", F.lit(fk)))
    if not parts:
        return target.withColumn("failed_fk", F.lit(None).cast("string")).limit(0)
    return reduce(DataFrame.unionByName, parts)


def fk_samples(
    target: DataFrame,
    rules: Sequence[Mapping],
    resolve: Resolver | None = None,
    *,
    n: int = 5,
    nulls: str = "fail",
    max_broadcast_bytes: int | None = None,
) -> DataFrame:
    """The ``n`` smallest orphan FK values per rule, with their row counts.

    Deterministic (ordered by value, nulls first), unlike a bare ``limit``. From
    the same tagged union as the report: one scan of the target for all rules,
    and at most ``n`` rows a rule and task are ranked.
    """
    prepared = list(_prepare(target, rules, resolve))
    checks = _checks(target, prepared)
    if not checks:
        return target.sparkSession.createDataFrame(
            [], "rule_idx int, foreign_key string, rank int, value string, n_rows long")
    keys = _key_columns(checks)
    order = [F.col(k).asc_nulls_first() for k in keys.values()]  # a rule has values in one of them
    ranked = _orphans(target, checks, nulls, max_broadcast_bytes).withColumn("rank", F.row_number().over(Window.partitionBy("rule_idx").orderBy(*order)))
    own = [(F.col("rule_idx") == c.idx, c.fk, F.col(keys[c.kind]).cast(target.schema[c.fk].dataType).cast("string")) for c in checks]
    return ranked.filter(F.col("rank") <= n).select(
        "rule_idx", F.coalesce(*[F.when(mine, F.lit(fk)) for mine, fk, _ in own]).alias("foreign_key"), "rank",
        F.coalesce(*[F.when(mine, value) for mine, _, value in own]).alias("value"), "n_rows")
