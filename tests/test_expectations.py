"""Expectation suites: counts, mostly, unknown types, empty suite."""

from sievekit.operators import expectations as E


def test_suite(spark):
    df = spark.createDataFrame([("GCF_1", 10.0), ("bad id!", 50.0), (None, 150.0), ("GCA_2", None)],
                               "genome_id string, score double")
    exps = [
        {"expectation_type": "expect_column_values_to_not_be_null", "params": {"column": "genome_id"}},
        {"expectation_type": "expect_column_values_to_match_regex",
         "params": {"column": "genome_id", "regex": "^[A-Za-z0-9_.-]+$"}},
        {"expectation_type": "expect_column_values_to_be_between",
         "params": {"column": "score", "min_value": 0, "max_value": 100}},
        {"expectation_type": "expect_column_values_to_be_between",
         "params": {"column": "score", "min_value": 0, "max_value": 100, "mostly": 0.6}},
        {"expectation_type": "expect_column_to_exist", "params": {"column": "genome_id"}},
        {"expectation_type": "expect_column_to_exist", "params": {"column": "sample_id"}},
        {"expectation_type": "expect_something_new", "params": {"column": "genome_id"}},
    ]
    rep = {r.exp_idx: r for r in E.expectation_report(df, exps).collect()}
    assert (rep[0].unexpected_count, rep[0].success) == (1, False)
    assert (rep[1].unexpected_count, rep[1].missing_count, rep[1].unexpected_percent) == (1, 1, 100.0 / 3)
    assert (rep[2].unexpected_count, rep[2].success) == (1, False)
    assert rep[3].success is True
    assert rep[4].success is True and rep[5].success is False
    assert rep[6].status == "unknown" and rep[6].success is None
    stats = E.suite_statistics(E.expectation_report(df, exps)).first()
    assert (stats.successful_expectations, stats.unsuccessful_expectations) == (2, 4)
    assert abs(stats.success_percent - 100 * 2 / 6) < 1e-12


def test_five_of_six_is_83_33(spark):
    df = spark.createDataFrame([("a",)], "c string")
    exps = [{"expectation_type": "expect_column_to_exist", "params": {"column": "c"}}] * 5 + \
        [{"expectation_type": "expect_column_to_exist", "params": {"column": "d"}}]
    stats = E.suite_statistics(E.expectation_report(df, exps)).first()
    assert round(stats.success_percent, 2) == 83.33


def test_empty_suite(spark):
    df = spark.createDataFrame([("a",)], "c string")
    stats = E.suite_statistics(E.expectation_report(df, [])).first()
    assert stats.success is True and stats.success_percent is None
