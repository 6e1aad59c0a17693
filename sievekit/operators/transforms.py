"""Declared column transformations (``transformations`` config section).

The config names an operation per column; the only named one is
``trim_whitespace``. Each operation is a ``Column -> Column`` function, so the
whole list becomes one projection.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPERATIONS: dict[str, Callable[[Column, object], Column]] = {
    "trim_whitespace": lambda c, _v: F.trim(c),
}


def apply_transformations(df: DataFrame, transformations: Sequence[Mapping]) -> DataFrame:
    """Apply ``[{column_name, operation, value?}]`` in order; unknown ones raise."""
    exprs = {c: F.col(f"`{c}`") for c in df.columns}
    for t in transformations or []:
        name, op = t.get("column_name"), t.get("operation")
        if name not in exprs:
            raise ValueError(f"transformation on unknown column: {name!r}")
        if op not in OPERATIONS:
            raise ValueError(f"unknown transformation operation: {op!r}")
        exprs[name] = OPERATIONS[op](exprs[name], t.get("value"))
    return df.select(*[e.alias(c) for c, e in exprs.items()])
