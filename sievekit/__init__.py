"""sievekit: table checks and curation as Spark DataFrame operators.

Operators take DataFrames and return DataFrames; import them from the
submodules, or use the shortcuts below.
"""

from sievekit.operators.audit import audit_configs, audit_verdict  # noqa: F401
from sievekit.operators.expectations import expectation_report, expectation_samples, suite_statistics  # noqa: F401
from sievekit.operators.groups import explode_members, filter_stage, regroup  # noqa: F401
from sievekit.operators.integrity import fk_report, fk_samples, fk_verdict, fk_violations  # noqa: F401
from sievekit.operators.pairs import already_removed, pair_coverage, removed_members, valid_pairs  # noqa: F401
from sievekit.operators.rules import rule_report, violation_rows, violation_samples  # noqa: F401
from sievekit.operators.runlog import filter_logs, parse_log_lines, read_run_logs  # noqa: F401
from sievekit.operators.stats import exact_median, group_stats  # noqa: F401

__version__ = "0.1.0"
