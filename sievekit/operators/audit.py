"""Config audit (A1-A7): many pipeline configs checked as one DataFrame.

Input: a DataFrame with ``config`` (name) and ``json`` (the document text),
e.g. ``read_config_folder``. Every check is a row-local JSON expression
(``json_object_keys``, ``from_json``, ``transform``), so a folder of configs
is audited in one narrow pass. Output rows: (config, check_order, section,
message) in the validator's section order.
"""

from __future__ import annotations

import json as _json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Section names and required keys of the config format.
LOADER_REQUIRED = (
    "target_table", "schema_file_path", "input_files", "output_file", "bronze", "silver",
    "transformations", "validations", "referential_integrity", "schema_drift_handling",
    "great_expectations_validations", "logging", "versioning",
)
VALIDATOR_REQUIRED = ("target_table", "schema_file_path", "input_files", "output_file")
AUDITED = (
    "input_files", "output_file", "transformations", "validations", "referential_integrity",
    "great_expectations_validations", "schema_drift_handling", "logging", "versioning",
)
INPUT_FILE_KEYS = ("source", "file_path", "file_type", "delimiter", "ignore_first_line")
OUTPUT_FILE_KEYS = ("output_file_path", "file_type", "delimiter", "ignore_first_line")
VALIDATION_KEYS = ("column", "validation_type", "error_message")
RI_KEYS = ("foreign_key", "reference_table", "reference_column", "database", "action")
SCHEMA_DRIFT_KEYS = ("action", "log_table", "log_path")
LOGGING_KEYS = ("error_table", "output_delta_path")
VERSIONING_KEYS = ("version_tag", "created_by", "created_at")
# Message texts of the config validator.
MSG_MISSING_REQUIRED = "Missing required field: "
MSG_MISSING_FIELD = "Missing field: "
MSG_INPUT_NOT_LIST = "input_files must be a list"
MSG_TRANSFORMATION_KEYS = "Each transformation must include 'column_name' and 'operation'"
MSG_EXPECTATION_KEYS = "Each entry must have 'expectation_type' and 'params'"
#: a date, extended or basic, and with it a time and an offset
ISO_TIME = (r"^(\d{4}-\d{2}-\d{2}|\d{8})"
            r"([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{3}(\d{3})?)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$")
ISO_BASIC_DATE = r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])"
MSG_BAD_CREATED_AT = "'created_at' is not a valid ISO timestamp"


class ConfigValidationError(Exception):
    """Raised by ``assert_valid`` when a config has errors."""


def read_config_folder(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON file: (config = file name without .json, json text)."""
    docs = spark.read.text(path, wholetext=True)
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")
    return docs.select(name.alias("config"), F.col("value").alias("json"))


def configs_from_dicts(spark: SparkSession, configs: dict[str, object]) -> DataFrame:
    """Small helper for tests and notebooks: {name: document} to the audit input."""
    return spark.createDataFrame([(k, _json.dumps(v)) for k, v in configs.items()], "config string, json string")


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _keys(text: Column) -> Column:
    return F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))


def _err(section: Column | str, message: Column | str) -> Column:
    sec = F.lit(section) if isinstance(section, str) else section
    msg = F.lit(message) if isinstance(message, str) else message
    return F.struct(sec.alias("section"), msg.alias("message"))


def _missing(section: Column | str, text: Column, required, fmt: str = MSG_MISSING_FIELD) -> Column:
    missing = F.array_except(_lit_array(required), _keys(text))
    return F.transform(missing, lambda k: _err(section, F.concat(F.lit(fmt), k)))


def _items(text: Column) -> Column:
    """Elements of a JSON array as JSON texts (empty when absent or not an array)."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def _per_item(name: str, text: Column, fn) -> Column:
    """Errors of a section's items; a section that is there but no list is one error."""
    wrong = text.isNotNull() & F.json_array_length(text).isNull()
    return F.when(wrong, F.array(_err(name, f"{name} must be a list"))).otherwise(_each_item(name, text, fn))


def _each_item(name: str, text: Column, fn) -> Column:
    return F.flatten(F.transform(_items(text), lambda item, i: fn(
        F.concat(F.lit(f"{name}["), i.cast("string"), F.lit("]")), item)))


def _all_keys_or_one(section: Column, item: Column, keys, message: str) -> Column:
    has_all = F.size(F.array_except(_lit_array(keys), _keys(item))) == 0
    return F.when(has_all, F.array().cast("array<struct<section:string,message:string>>")) \
        .otherwise(F.array(_err(section, message)))


def _nonempty_object(text: Column) -> Column:
    return F.coalesce(F.size(F.json_object_keys(text)) > 0, F.lit(False))


def audit_configs(configs: DataFrame, json_col: str = "json", name_col: str = "config") -> DataFrame:
    """One row per error.

    Each section is taken out of the document once, in a projection of its own:
    the checks look at it several times."""
    doc = F.col(json_col)
    sections = configs.select(F.col(name_col).alias("config"), _keys(doc).alias("__top"),
                              *[F.get_json_object(doc, f"$.{name}").alias(f"__{name}") for name in AUDITED])

    def sec(name: str) -> Column:
        return F.col(f"__{name}")

    empty = F.array().cast("array<struct<section:string,message:string>>")
    top = F.col("__top")
    required = F.transform(
        F.array_except(_lit_array(VALIDATOR_REQUIRED), top),
        lambda k: _err("required_fields", F.concat(F.lit(MSG_MISSING_REQUIRED + "'"), k, F.lit("'"))))
    inputs_text = sec("input_files")
    inputs = F.when(~F.array_contains(top, "input_files"), empty).when(
        F.json_array_length(inputs_text).isNull(), F.array(_err("input_files", MSG_INPUT_NOT_LIST))  # null included
    ).otherwise(_per_item("input_files", inputs_text, lambda s, item: _missing(s, item, INPUT_FILE_KEYS)))
    output = _missing("output_file", sec("output_file"), OUTPUT_FILE_KEYS)
    transformations = _per_item("transformations", sec("transformations"), lambda s, item: _all_keys_or_one(
        s, item, ("column_name", "operation"), MSG_TRANSFORMATION_KEYS))
    validations = _per_item("validations", sec("validations"), lambda s, item: _missing(s, item, VALIDATION_KEYS))
    ri = _per_item("referential_integrity", sec("referential_integrity"), lambda s, item: _missing(s, item, RI_KEYS))
    ge = _per_item("great_expectations_validations", sec("great_expectations_validations"),
                   lambda s, item: _all_keys_or_one(s, item, ("expectation_type", "params"), MSG_EXPECTATION_KEYS))

    def when_nonempty(name: str, keys) -> Column:
        t = sec(name)
        return F.when(_nonempty_object(t), _missing(name, t, keys)).otherwise(empty)

    drift = when_nonempty("schema_drift_handling", SCHEMA_DRIFT_KEYS)
    logging = when_nonempty("logging", LOGGING_KEYS)
    ver_text = sec("versioning")
    created = F.get_json_object(ver_text, "$.created_at")
    bad_time = created.isNull() | ~created.rlike(ISO_TIME) | F.try_to_timestamp(F.regexp_replace(created, ISO_BASIC_DATE, "$1-$2-$3")).isNull()
    versioning = F.when(_nonempty_object(ver_text), F.concat(
        _missing("versioning", ver_text, VERSIONING_KEYS),
        F.when(bad_time, F.array(_err("versioning", MSG_BAD_CREATED_AT))).otherwise(empty),
    )).otherwise(empty)

    errors = F.concat(required, inputs, output, transformations, validations, ri, ge, drift, logging, versioning)
    return sections.select("config", F.posexplode(errors).alias("check_order", "e")).select(
        "config", "check_order", "e.section", "e.message")


def loader_missing_sections(configs: DataFrame, json_col: str = "json", name_col: str = "config") -> DataFrame:
    """A1 (loader form): the 13 sections every config must name."""
    missing = F.array_except(_lit_array(LOADER_REQUIRED), _keys(F.col(json_col)))
    return configs.select(F.col(name_col).alias("config"), F.explode(missing).alias("missing_section"))


def audit_verdict(configs: DataFrame, errors: DataFrame, name_col: str = "config") -> DataFrame:
    """Per config, the number of errors and whether it is valid."""
    counts = errors.groupBy("config").agg(F.count(F.lit(1)).alias("n_errors"))
    out = configs.select(F.col(name_col).alias("config")).join(counts, "config", "left")
    return out.select("config", F.coalesce("n_errors", F.lit(0)).alias("n_errors")) \
        .withColumn("valid", F.col("n_errors") == 0)


def assert_valid(errors: DataFrame, config: str, dry_run: bool = False) -> bool:
    """True when ``config`` has no errors; otherwise False on a dry run,
    else raise with every error (a config's error list is small)."""
    rows = errors.filter(F.col("config") == config).orderBy("check_order").collect()
    if not rows:
        return True
    if dry_run:
        return False
    raise ConfigValidationError(_json.dumps([{"section": r.section, "message": r.message} for r in rows], indent=2))
