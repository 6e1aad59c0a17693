"""Property tests: rule counts against a Python model, medians against numpy."""

import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sievekit.operators import rules as R
from sievekit.operators.stats import exact_median

TOKENS = st.one_of(st.none(), st.sampled_from(["", " ", "a", "b", "abc", "NaN", "inf", "-inf", "1e3", " 7 ",
                                                "0", "100", "-5", "50.5", "1_0", "x1"]))
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _as_number(v):
    """Spark's string -> double reading for the tokens above (None if it does not parse)."""
    if v is None:
        return None
    t = v.strip()
    if t.lower() in ("nan",):
        return math.nan
    if t.lower() in ("inf", "+inf", "infinity"):
        return math.inf
    if t.lower() in ("-inf", "-infinity"):
        return -math.inf
    if "_" in t or t == "":
        return None
    try:
        return float(t)
    except ValueError:
        return None


def _model(values, lo, hi, allowed):
    def range_bad(v):
        if v is None:
            return False
        x = _as_number(v)
        if x is None:
            return True
        if math.isnan(x):
            return hi is not None  # NaN sorts above every number
        return (lo is not None and x < lo) or (hi is not None and x > hi)
    return {
        0: sum(1 for v in values if v is None or v == ""),
        1: sum(1 for v in values if range_bad(v)),
        2: sum(1 for v in values if v is not None and v not in allowed),
        3: sum(1 for v in values if v is not None and not any(ch.isdigit() for ch in v)),
    }


@SETTINGS
@given(values=st.lists(TOKENS, min_size=1, max_size=25),
       lo=st.one_of(st.none(), st.integers(-10, 10)), hi=st.one_of(st.none(), st.integers(20, 200)),
       allowed=st.lists(st.sampled_from(["a", "b", "0", "100"]), min_size=1, max_size=3, unique=True))
def test_rule_counts_match_model(spark, values, lo, hi, allowed):
    if lo is None and hi is None:
        hi = 100
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    rules = [{"column": "v", "validation_type": "not_null"},
             {"column": "v", "validation_type": "numeric_range", "min": lo, "max": hi},
             {"column": "v", "validation_type": "allowed_values", "values": allowed},
             {"column": "v", "validation_type": "regex_match", "pattern": "[0-9]"}]
    got = {r.rule_idx: r.n_violations for r in R.rule_report(df, rules).collect()}
    assert got == _model(values, lo, hi, allowed)
    assert R.violation_rows(df, rules, ["id"]).count() == sum(got.values())


@SETTINGS
@given(groups=st.lists(st.tuples(st.integers(0, 3), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=200),
       accuracy=st.sampled_from([10, 100, 100000]))
def test_exact_median_matches_numpy(spark, groups, accuracy):
    df = spark.createDataFrame(groups, "g int, x double")
    got = {r.g: r.x_median for r in exact_median(df, ["g"], "x", accuracy).collect()}
    for g in {k for k, _ in groups}:
        xs = np.array([x for k, x in groups if k == g])
        assert math.isclose(got[g], float(np.median(xs)), rel_tol=1e-12, abs_tol=1e-9)
