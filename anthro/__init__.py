"""anthro: LMS z-scores for clinical measurements on Spark DataFrames."""

from anthro.functions.codes import gender_decode, provenance_label, source_label
from anthro.functions.dates import age_in_months
from anthro.functions.lms import is_valid_z, lms_zscore, strict_z_filter
from anthro.operators.bracket import Brackets, bracket_lookup, build_brackets, interpolate
from anthro.operators.cohort import (DuplicateKeyError, check_unique, measurement_cohort,
                                     select_measurements, select_persons)
from anthro.operators.day_table import DayTable, build_day_table, day_lookup
from anthro.operators.records import zscore_records
from anthro.operators.skew import find_hot_keys, join_with_hot_keys
from anthro.operators.zscore import lms_interpolate, lms_parameters, with_zscore
from anthro.plans.inspect import plan_text
from anthro.plans.zscore_job import bmi_zscore, run_zscore_job
from anthro.sources.grids import (GRID_SCHEMA, GridError, grid_from_rows, read_grid_csv,
                                  rule_grid, union_sexes, validate_grid)
from anthro.sources.sinks import read_zscores, write_zscores
from anthro.sources.tables import read_source, save_bucketed_by_person

__all__ = [
    "Brackets", "DayTable", "DuplicateKeyError", "GRID_SCHEMA", "GridError", "age_in_months",
    "bmi_zscore", "bracket_lookup", "build_brackets", "build_day_table", "check_unique",
    "day_lookup", "find_hot_keys", "gender_decode", "grid_from_rows", "interpolate",
    "is_valid_z", "join_with_hot_keys", "lms_interpolate", "lms_parameters", "lms_zscore",
    "measurement_cohort", "plan_text", "provenance_label", "read_grid_csv", "read_source",
    "read_zscores", "rule_grid", "run_zscore_job", "save_bucketed_by_person",
    "select_measurements", "select_persons", "source_label", "strict_z_filter",
    "union_sexes", "validate_grid", "with_zscore", "write_zscores", "zscore_records",
]
