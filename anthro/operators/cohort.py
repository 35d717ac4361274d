"""Measurement cohort (OP-D1): selected measurements joined to persons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anthro.constants import (BMI_CONCEPT_ID, DAYS_PER_MONTH, DERIVED_TYPE_CONCEPT_ID,
                              FEMALE_CONCEPT_ID, MALE_CONCEPT_ID, UNIT_KG_PER_M2)
from anthro.functions.codes import gender_decode
from anthro.functions.dates import DAYS_PER_MONTH_KEY, age_in_months
from anthro.operators.skew import join_with_hot_keys


def select_measurements(measurement: DataFrame, concept_id: int = BMI_CONCEPT_ID,
                        unit_concept_id: int = UNIT_KG_PER_M2,
                        type_concept_id: int = DERIVED_TYPE_CONCEPT_ID) -> DataFrame:
    """Measurement rows of one concept, unit and type with a value and a time.

    Plain column predicates, so a parquet/ORC scan receives them as pushed
    filters and skips row groups.
    """
    m = F.col
    return measurement.filter(
        (m("measurement_concept_id") == F.lit(concept_id))
        & m("value_as_number").isNotNull()
        & (m("unit_concept_id") == F.lit(unit_concept_id))
        & (m("measurement_type_concept_id") == F.lit(type_concept_id))
        & m("measurement_datetime").isNotNull())


def select_persons(person: DataFrame,
                   sex_concept_ids=(MALE_CONCEPT_ID, FEMALE_CONCEPT_ID)) -> DataFrame:
    """Persons of a known sex with a birth time."""
    return person.filter(F.col("gender_concept_id").isin(list(sex_concept_ids))
                         & F.col("birth_datetime").isNotNull())


def measurement_cohort(measurement: DataFrame, person: DataFrame, *,
                       concept_id: int = BMI_CONCEPT_ID,
                       days_per_month: float = DAYS_PER_MONTH,
                       hot_key_fraction: float | None = None,
                       hot_key_strategy: str = "salt") -> DataFrame:
    """Selected measurements with sex and age in months (11 columns).

    The join is on ``(site_id, person_id)`` when ``person`` carries
    ``site_id``, so sites may use the same person ids; otherwise on
    ``person_id``, and persons are taken to be common to all sites.

    Both sides are pruned to the columns used before the join.  The join
    is left to the planner: with AQE it becomes a broadcast
    join when the filtered person side is measured small, else a sort-merge
    join whose skewed partitions AQE splits.  ``hot_key_fraction`` adds an
    explicit split of persons that own more than that fraction of the rows
    (see :func:`join_with_hot_keys`; ``hot_key_strategy="split"`` for
    inputs bucketed on ``person_id``).
    """
    m = select_measurements(measurement, concept_id).select(
        "measurement_id", "person_id", "value_as_number", "value_source_value",
        "measurement_datetime", "site_id", "provider_id", "visit_occurrence_id")
    keys = ["site_id", "person_id"] if "site_id" in person.columns else ["person_id"]
    p = select_persons(person).select(*keys, "gender_concept_id", "birth_datetime")
    if hot_key_fraction:
        j = join_with_hot_keys(m, p, keys, hot_fraction=hot_key_fraction,
                               strategy=hot_key_strategy)
    else:
        j = m.join(p, keys, "inner")
    return j.select(
        "measurement_id",
        "person_id",
        F.col("value_as_number").alias("bmi_value"),
        F.col("value_source_value").alias("bmi_source_value"),
        age_in_months("measurement_datetime", "birth_datetime", days_per_month)
        .alias("age_in_months", metadata={DAYS_PER_MONTH_KEY: float(days_per_month)}),
        gender_decode("gender_concept_id").alias("gender"),
        "measurement_datetime",
        "birth_datetime",
        "site_id",
        "provider_id",
        "visit_occurrence_id",
    )


class DuplicateKeyError(ValueError):
    """A key column meant to be unique holds a value twice."""


def check_unique(df: DataFrame, key: str | list[str]) -> None:
    """Raise :class:`DuplicateKeyError` if ``key`` (one or more columns) repeats in ``df``.

    The lookup keeps every input row, so duplicate ids do not collapse or
    mis-pair rows as a window over the id would; the check is for callers
    whose downstream tables need the id to be unique.  One aggregation with
    partial counts before the shuffle; at most one row reaches the driver.
    """
    keys = [key] if isinstance(key, str) else list(key)
    dup = (df.filter(F.col(keys[-1]).isNotNull()).groupBy(*keys).count()
           .filter(F.col("count") > 1).limit(1).collect())
    if dup:
        value = ", ".join(f"{k} {dup[0][k]!r}" for k in keys)
        raise DuplicateKeyError(f"{value} occurs {dup[0]['count']} times")
