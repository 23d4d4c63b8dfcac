"""Table quality and entity coverage on Spark DataFrames.

Every public function takes DataFrames and returns DataFrames.  Rules and other
settings are plain dataclasses that are compiled to Column expressions.
"""
from assayframe.rules import Config, DatasetSettings, Rules, UnknownRuleKey, load_config
from assayframe.operators.checks import run_checks
from assayframe.operators.report import build_report, build_summary
from assayframe.plans.validate import validate_frame, validate_source

__all__ = [
    "Config",
    "DatasetSettings",
    "Rules",
    "UnknownRuleKey",
    "load_config",
    "run_checks",
    "build_report",
    "build_summary",
    "validate_frame",
    "validate_source",
]
