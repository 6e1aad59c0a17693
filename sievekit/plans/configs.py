"""Rule sets used by the registered queries (config sections as Python data)."""

LINEITEM_RULES = [
    {"column": "l_returnflag", "validation_type": "not_null", "error_message": "return flag is required"},
    {"column": "l_quantity", "validation_type": "numeric_range", "min": 1, "max": 40,
     "error_message": "quantity out of range"},
    {"column": "l_returnflag", "validation_type": "allowed_values", "values": ["A", "R"],
     "error_message": "unexpected return flag"},
    {"column": "l_linestatus", "validation_type": "regex_match", "pattern": "^[OF]$",
     "error_message": "bad line status"},
    {"column": "l_discount", "validation_type": "numeric_range", "max": 0.08,
     "error_message": "discount too high"},
    {"column": "l_comment", "validation_type": "not_null", "error_message": "comment is required"},
    {"column": "l_tax", "validation_type": "is_positive", "error_message": "tax must be positive"},
    {"column": "l_linestatus", "validation_type": "regex_match", "error_message": "no pattern given"},
]

LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]

CUSTOMER_TRANSFORMS = [{"column_name": "c_mktsegment", "operation": "trim_whitespace"}]

CUSTOMER_RULES = [
    {"column": "c_name", "validation_type": "regex_match", "pattern": "Customer#0000001[0-9]{2}",
     "error_message": "name outside the first block"},
    {"column": "c_acctbal", "validation_type": "numeric_range", "min": 0, "max": 9000,
     "error_message": "balance out of range"},
    {"column": "c_mktsegment", "validation_type": "allowed_values",
     "values": ["BUILDING", "MACHINERY", "AUTOMOBILE"], "error_message": "unknown segment"},
    {"column": "c_name", "validation_type": "not_null", "error_message": "name is required"},
    {"column": "c_acctbal", "validation_type": "numeric_range", "error_message": "no bounds"},
    {"column": "c_mktsegment", "validation_type": "allowed_values", "values": [],
     "error_message": "empty list"},
]

LINEITEM_FKS = [
    {"foreign_key": "l_orderkey", "reference_table": "orders_finished", "reference_column": "o_orderkey",
     "database": "tpch", "action": "log"},
    {"foreign_key": "l_partkey", "reference_table": "part_small", "reference_column": "p_partkey",
     "database": "tpch", "action": "log"},
    {"foreign_key": "l_suppkey", "reference_table": "supplier", "reference_column": "s_suppkey",
     "database": "tpch", "action": "log"},
    {"foreign_key": "l_shipkey", "reference_table": "supplier", "reference_column": "s_suppkey",
     "database": "tpch", "action": "log"},
    {"foreign_key": "l_partkey", "reference_table": "part_archive", "reference_column": "p_partkey",
     "database": "tpch", "action": "log"},
    {"foreign_key": "l_suppkey", "reference_table": "supplier", "reference_column": "s_id",
     "database": "tpch", "action": "log"},
]

ORDERS_FKS = [
    {"foreign_key": "o_custkey", "reference_table": "customer_building", "reference_column": "c_custkey",
     "database": "tpch", "action": "log"},
    {"foreign_key": "o_orderkey", "reference_table": "lineitem", "reference_column": "l_orderkey",
     "database": "tpch", "action": "count"},
]

ORDERS_EXPECTATIONS = [
    {"expectation_type": "expect_column_values_to_not_be_null", "params": {"column": "o_orderkey"}},
    {"expectation_type": "expect_column_values_to_match_regex",
     "params": {"column": "o_orderpriority", "regex": "^[1-3]-"}},
    {"expectation_type": "expect_column_values_to_be_between",
     "params": {"column": "o_totalprice", "min_value": 1000, "max_value": 400000}},
    {"expectation_type": "expect_column_values_to_be_between",
     "params": {"column": "o_totalprice", "min_value": 0, "max_value": 600000, "mostly": 0.95}},
    {"expectation_type": "expect_column_values_to_not_be_null", "params": {"column": "o_priority_or_null"}},
    {"expectation_type": "expect_column_to_exist", "params": {"column": "o_orderdate"}},
    {"expectation_type": "expect_column_to_exist", "params": {"column": "o_comment"}},
    {"expectation_type": "expect_table_row_count_to_equal", "params": {"value": 10}},
]

DOCUMENT_RULES = [
    {"column": "text", "validation_type": "not_null", "error_message": "text is required"},
    {"column": "n_chars", "validation_type": "numeric_range", "min": 1, "max": 20000,
     "error_message": "document length out of range"},
    {"column": "lang", "validation_type": "allowed_values", "values": ["en", "de", "fr"],
     "error_message": "unsupported language"},
    {"column": "source", "validation_type": "regex_match", "pattern": "^src[0-9]+$",
     "error_message": "bad source id"},
    {"column": "text", "validation_type": "regex_match", "pattern": "[A-Za-z]{3}",
     "error_message": "no latin word"},
]

CUSTOMER_EXPECTATIONS = [
    {"expectation_type": "expect_column_values_to_not_be_null", "params": {"column": "c_custkey"}},
    {"expectation_type": "expect_column_values_to_be_between", "params": {"column": "c_acctbal", "min_value": 0}},
    {"expectation_type": "expect_column_values_to_be_between",
     "params": {"column": "c_acctbal", "min_value": 0, "mostly": 0.9}},
    {"expectation_type": "expect_column_values_to_match_regex", "params": {"column": "c_mktsegment", "regex": "^[A-Z]+$"}},
    {"expectation_type": "expect_column_to_exist", "params": {"column": "c_phone"}},
    {"expectation_type": "expect_column_values_to_be_between",
     "params": {"column": "c_nationkey", "min_value": 0, "max_value": 24, "strict_max": True}},
]

CLEAN_FKS = {
    "customer": [{"foreign_key": "c_nationkey", "reference_table": "nation", "reference_column": "n_nationkey",
                  "database": "tpch", "action": "log"}],
    "nation": [{"foreign_key": "n_regionkey", "reference_table": "region", "reference_column": "r_regionkey",
                "database": "tpch", "action": "log"}],
    "events": [{"foreign_key": "user_id", "reference_table": "customer", "reference_column": "c_custkey",
                "database": "tpch", "action": "log"}],
    "labels": [{"foreign_key": "doc_id", "reference_table": "documents", "reference_column": "doc_id",
                "database": "tpch", "action": "log"}],
}

EVENT_RULES = [
    {"column": "event_type", "validation_type": "allowed_values", "values": ["click", "view", "purchase"],
     "error_message": "unexpected event type"},
    {"column": "props", "validation_type": "regex_match", "pattern": '^\\{"k": [0-9]+\\}$',
     "error_message": "props not in the k form"},
    {"column": "value", "validation_type": "numeric_range", "min": 0, "max": 300,
     "error_message": "value out of range"},
    {"column": "props", "validation_type": "numeric_range", "min": 0,
     "error_message": "props is not a number"},
    {"column": "user_id", "validation_type": "allowed_values", "values": ["1", "2", "3"],
     "error_message": "user outside the first three"},
]
