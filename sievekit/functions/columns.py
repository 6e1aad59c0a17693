"""Row-local column expressions used by the curation and rule operators.

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The seven ANI groups of the curation notebook, in its order.
# Each entry is (label, low_exclusive, high_inclusive); an entry whose two
# bounds are equal matches that exact value. Anything else, including nulls,
# values above 100 and values in (99.9, 100), gets the fallback label.
ANI_BUCKETS: tuple[tuple[str, float, float], ...] = (
    ("Group1: 100", 100.0, 100.0),
    ("Group2: 99.9-99.5", 99.5, 99.9),
    ("Group3: 99.5-99.0", 99.0, 99.5),
    ("Group4: 99.0-98.5", 98.5, 99.0),
    ("Group5: 98.5-98.0", 98.0, 98.5),
    ("Group6: 98.0-97.0", 97.0, 98.0),
)
ANI_FALLBACK = "Group7: LT 97.0"

# The curation notebook's Stage-1 filter defaults and the six
# ranks of a ';'-joined taxonomy string, in their order.
EXCLUDED_VERSION_STATUS = ("suppressed",)
EXCLUDED_WARNINGS = (
    "fragmented assembly", "genome length too large", "genome length too small", "hybrid",
    "low quality sequence", "misassembled", "partial", "annotation fails completeness check",
    "low gene count", "RefSeq annotation failed", "many frameshifted proteins",
)
TAXONOMY_RANKS = ("domain", "phylum", "class", "order", "family", "genus")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket_label(
    c: str | Column,
    buckets: Sequence[tuple[str, float, float]] = ANI_BUCKETS,
    fallback: str = ANI_FALLBACK,
) -> Column:
    """K1: label a numeric column by the first bucket that holds it."""
    x = _col(c)
    expr = None
    for label, low, high in buckets:
        cond = (x == F.lit(high)) if low == high else ((x > F.lit(low)) & (x <= F.lit(high)))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(fallback) if expr is None else expr.otherwise(F.lit(fallback))


def _split(c: Column, sep: str) -> Column:
    # F.split takes a Java regex; quote the separator so it is literal.
    return F.split(c, re.escape(sep) if sep not in ("\n", "\t") else sep)


def split_to_columns(c: str | Column, sep: str, names: Sequence[str]) -> list[Column]:
    """K2: split a delimited path into named columns; missing parts are null."""
    parts = _split(_col(c), sep)
    return [F.get(parts, i).alias(name) for i, name in enumerate(names)]


def split_width(c: str | Column, sep: str) -> Column:
    """Number of parts of a delimited path (for K2 width checks)."""
    return F.size(_split(_col(c), sep))


def compose_key(a: str | Column, b: str | Column, sep: str = "--", blank: str = "_") -> Column:
    """K3: ``a + sep + b`` with every blank replaced."""
    return F.regexp_replace(F.concat(_col(a), F.lit(sep), _col(b)), " ", blank)


def split_list(c: str | Column, sep: str = "; ") -> Column:
    """K5: string to list; a null string becomes a one-element list ``[null]``."""
    return F.coalesce(_split(_col(c), sep), F.array(F.lit(None).cast("string")))


def strip_prefix(c: str | Column, n: int = 3) -> Column:
    """K7: drop the first ``n`` characters (an id source prefix)."""
    x = _col(c)
    return F.substring(x, n + 1, 1 << 30)


def flag(pred: Column) -> Column:
    """K8: 0/1 flag; a null predicate counts as 0."""
    return F.when(pred, F.lit(1)).otherwise(F.lit(0))


def list_overlap(
    scalar: str | Column | None,
    scalar_values: Sequence[str],
    items: str | Column | None,
    item_values: Sequence[str],
) -> Column:
    """Scalar in a set, or any list item in another set (never null)."""
    out = F.lit(False)
    if scalar is not None and scalar_values:
        out = out | F.coalesce(_col(scalar).isin(list(scalar_values)), F.lit(False))
    if items is not None and item_values:
        wanted = F.array(*[F.lit(v) for v in item_values])
        out = out | F.coalesce(F.arrays_overlap(_col(items), wanted), F.lit(False))
    return out


def row_min(a: str | Column, b: str | Column) -> Column:
    """Row-wise minimum that skips nulls."""
    return F.least(_col(a), _col(b))


def pair_key(a: str | Column, b: str | Column, sep: str = "_") -> Column:
    """Canonical key of an unordered pair (string order, as a sort would)."""
    sa, sb = _col(a).cast("string"), _col(b).cast("string")
    return F.concat_ws(sep, F.least(sa, sb), F.greatest(sa, sb))


def pairs_in_group(n: str | Column) -> Column:
    """Number of unordered pairs without selfs, n(n-1)/2, as a long."""
    x = _col(n).cast("long")
    return F.when(x > 1, (x * (x - 1)) / 2).otherwise(F.lit(0)).cast("long")


def text_key(c: str | Column) -> Column:
    """A 128-bit key for long text (two independent 64-bit xxhash values).

    Grouping or joining on it shuffles 16 bytes instead of the whole text; a
    false match needs a 128-bit collision (about N^2 / 2^129 for N distinct
    texts, below 1e-16 for 10^11 texts).
    """
    x = _col(c)
    return F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit("sievekit-text-key"), x).alias("h2"))


def split_taxonomy(c: str | Column, ranks=TAXONOMY_RANKS) -> list[Column]:
    """K2 with the default rank names."""
    return split_to_columns(c, ";", ranks)


def excluded_assembly(version_status: str | Column, warnings: str | Column,
                      statuses=EXCLUDED_VERSION_STATUS, excluded=EXCLUDED_WARNINGS) -> Column:
    """K5 + K10 with the Stage-1 defaults: a suppressed assembly, or any of its
    '; '-separated warnings in the excluded list."""
    return list_overlap(version_status, statuses, split_list(warnings, "; "), excluded)
