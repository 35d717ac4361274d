"""Shape z-scores into measurement records (OP-D5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anthro.constants import (DEFAULT_LABEL_PREFIX, DEFAULT_VERSION, DERIVED_TYPE_CONCEPT_ID,
                              OUTPUT_COLUMNS, OUTPUT_SOURCE_CONCEPT_ID, OUTPUT_UNIT_CONCEPT_ID,
                              OUTPUT_UNIT_SOURCE_VALUE, ZSCORE_CONCEPT_ID)
from anthro.functions.codes import provenance_label, source_label


def zscore_records(df: DataFrame, *, zscore_concept_id: int = ZSCORE_CONCEPT_ID,
                   version: str = DEFAULT_VERSION,
                   label_prefix: str = DEFAULT_LABEL_PREFIX) -> DataFrame:
    """Rows with ``z_score`` -> the 16 columns of a measurement record.

    The source ``measurement_id`` is kept; no new id is generated.
    """
    return df.select(
        "measurement_id",
        "person_id",
        F.lit(zscore_concept_id).cast("int").alias("measurement_concept_id"),
        F.col("measurement_datetime").cast("date").alias("measurement_date"),
        "measurement_datetime",
        F.lit(DERIVED_TYPE_CONCEPT_ID).cast("int").alias("measurement_type_concept_id"),
        F.lit(OUTPUT_UNIT_CONCEPT_ID).cast("int").alias("unit_concept_id"),
        F.lit(OUTPUT_UNIT_SOURCE_VALUE).alias("unit_source_value"),
        F.col("z_score").alias("value_as_number"),
        source_label("bmi_source_value").alias("value_source_value"),
        F.lit(provenance_label(version, label_prefix)).alias("measurement_source_value"),
        F.lit(OUTPUT_SOURCE_CONCEPT_ID).cast("int").alias("measurement_source_concept_id"),
        F.col("age_in_months").alias("measurement_age_in_months"),
        "site_id",
        "provider_id",
        "visit_occurrence_id",
    ).select(*OUTPUT_COLUMNS)
