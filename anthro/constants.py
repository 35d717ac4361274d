"""Fixed values of the z-score job.

These must equal the values the original job uses, otherwise the output
rows carry different codes. They are listed here, together, as plain text.
"""

# --- fixed values (OMOP-style concept codes and constants of the job) ------
BMI_CONCEPT_ID = 3038553            # measurement concept: body mass index
ZSCORE_CONCEPT_ID = 2000000043      # measurement concept written for the z-score
UNIT_KG_PER_M2 = 9531               # unit concept: kg/m2
DERIVED_TYPE_CONCEPT_ID = 45754907  # measurement type: derived value
MALE_CONCEPT_ID = 8507
FEMALE_CONCEPT_ID = 8532
DAYS_PER_MONTH = 30.44
OUTPUT_UNIT_CONCEPT_ID = 0
OUTPUT_UNIT_SOURCE_VALUE = "SD"
OUTPUT_SOURCE_CONCEPT_ID = 0
SOURCE_VALUE_PREFIX = "measurement: "
LABEL_TEMPLATE = "{prefix} Z score computation {version}"
DEFAULT_LABEL_PREFIX = "NHANES 2000"
DEFAULT_VERSION = "v1.0"

# The nine columns on which the original job re-joins its lower and upper
# halves with plain (not null-safe) equality.  Passing them as
# ``drop_null_keys`` reproduces the rows that join loses.
REJOIN_KEYS = (
    "measurement_id",
    "person_id",
    "measurement_datetime",
    "site_id",
    "provider_id",
    "visit_occurrence_id",
    "gender",
    "bmi_value",
    "age_in_months",
)

# Columns of the cohort that feeds the lookup (OP-D1).
COHORT_COLUMNS = (
    "measurement_id",
    "person_id",
    "bmi_value",
    "bmi_source_value",
    "age_in_months",
    "gender",
    "measurement_datetime",
    "birth_datetime",
    "site_id",
    "provider_id",
    "visit_occurrence_id",
)

# Columns of a written z-score record, in order.
OUTPUT_COLUMNS = (
    "measurement_id",
    "person_id",
    "measurement_concept_id",
    "measurement_date",
    "measurement_datetime",
    "measurement_type_concept_id",
    "unit_concept_id",
    "unit_source_value",
    "value_as_number",
    "value_source_value",
    "measurement_source_value",
    "measurement_source_concept_id",
    "measurement_age_in_months",
    "site_id",
    "provider_id",
    "visit_occurrence_id",
)
# --- end of fixed values ----------------------------------------------------

SEX_LABELS = {MALE_CONCEPT_ID: "male", FEMALE_CONCEPT_ID: "female"}
