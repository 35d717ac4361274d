"""Measurement and person tables derived from the driver's parquet tables.

The driver data holds no measurements; ``orders`` becomes one measurement
per order and ``customer`` one person per customer, by integer rules on
the keys (listed in FIXTURES.md).  The SQL check derives the same rows with
the same rules (``anthro.oracle``), so both engines start from equal input.
Everything is a projection of one scan: the tables grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from anthro.constants import (BMI_CONCEPT_ID, DERIVED_TYPE_CONCEPT_ID, FEMALE_CONCEPT_ID,
                              MALE_CONCEPT_ID, UNIT_KG_PER_M2)

# --- fixed values of the derivation rules (FIXTURES.md) ---------------------
OTHER_CONCEPT_ID = 3036277
OTHER_UNIT_CONCEPT_ID = 8582
OTHER_TYPE_CONCEPT_ID = 44818701
UNKNOWN_SEX_CONCEPT_ID = 8551
PRICE_DIVISOR = 20000.0
N_SITES = 5
BIRTH_BASE_DATE = "1977-01-01"
BIRTH_DAY_STEP = 37
BIRTH_DAY_RANGE = 8030
HOT_PERSON_ID = 2
HOT_EVERY = 3
SITE_BIRTH_STEP = 100
SITE_MEDIAN_STEP = 0.01
# --- end of fixed values ----------------------------------------------------


def measurement_from_orders(orders: DataFrame, hot_person: bool = False) -> DataFrame:
    """One measurement row per order (key k = o_orderkey).

    ``hot_person`` gives one person every third measurement, at any size.

    Written as SQL expressions (one projection, one call into the JVM).
    """
    base = f"(10.0D + o_totalprice / {PRICE_DIVISOR!r}D)"
    return orders.selectExpr(
        "o_orderkey AS measurement_id",
        (f"CASE WHEN o_orderkey % {HOT_EVERY} = 0 THEN CAST({HOT_PERSON_ID} AS BIGINT) ELSE o_custkey END" if hot_person
         else "o_custkey") + " AS person_id",
        f"CAST(CASE WHEN o_orderkey % 11 = 0 THEN {OTHER_CONCEPT_ID} ELSE {BMI_CONCEPT_ID} END AS INT)"
        " AS measurement_concept_id",
        f"CAST(CASE WHEN o_orderkey % 19 = 0 THEN {OTHER_TYPE_CONCEPT_ID} "
        f"ELSE {DERIVED_TYPE_CONCEPT_ID} END AS INT) AS measurement_type_concept_id",
        f"CAST(CASE WHEN o_orderkey % 17 = 0 THEN {OTHER_UNIT_CONCEPT_ID} ELSE {UNIT_KG_PER_M2} END AS INT)"
        " AS unit_concept_id",
        f"CASE WHEN o_orderkey % 13 = 0 THEN CAST(NULL AS DOUBLE) WHEN o_orderkey % 37 = 0 THEN 0.0D "
        f"WHEN o_orderkey % 41 = 0 THEN -{base} ELSE {base} END AS value_as_number",
        "CASE WHEN o_orderkey % 7 = 0 THEN CAST(NULL AS STRING) ELSE o_orderpriority END"
        " AS value_source_value",
        "CASE WHEN o_orderkey % 23 = 0 THEN CAST(NULL AS TIMESTAMP_NTZ) "
        "ELSE CAST(o_orderdate AS TIMESTAMP_NTZ) END AS measurement_datetime",
        f"concat('site_', CAST(o_custkey % {N_SITES} AS STRING)) AS site_id",
        "CAST(CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey % 7 END AS BIGINT) AS provider_id",
        "CAST(CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderkey END AS BIGINT)"
        " AS visit_occurrence_id",
    )


def person_from_customer(customer: DataFrame, by_site: bool = False) -> DataFrame:
    """One person row per customer (key c = c_custkey).

    ``by_site`` gives every site a person of every id, born ``SITE_BIRTH_STEP``
    days apart: equal ids then mean different persons.
    """
    days = f"(c_custkey * {BIRTH_DAY_STEP}) % {BIRTH_DAY_RANGE}"
    site = []
    if by_site:
        customer = customer.selectExpr("c_custkey", f"explode(sequence(0, {N_SITES - 1})) AS site_no")
        days += f" + {SITE_BIRTH_STEP} * site_no"
        site = ["concat('site_', CAST(site_no AS STRING)) AS site_id"]
    birth = f"date_add(DATE'{BIRTH_BASE_DATE}', CAST({days} AS INT))"
    return customer.selectExpr(
        "c_custkey AS person_id",
        f"CAST(CASE WHEN c_custkey % 43 = 0 THEN {UNKNOWN_SEX_CONCEPT_ID} "
        f"WHEN c_custkey % 2 = 0 THEN {MALE_CONCEPT_ID} ELSE {FEMALE_CONCEPT_ID} END AS INT)"
        " AS gender_concept_id",
        f"CASE WHEN c_custkey % 31 = 0 THEN CAST(NULL AS TIMESTAMP_NTZ) "
        f"ELSE CAST({birth} AS TIMESTAMP_NTZ) END AS birth_datetime",
        *site,
    )


def site_grid(grid: DataFrame, site: int) -> DataFrame:
    """The grid of one site: M larger by ``SITE_MEDIAN_STEP`` times the site's number."""
    return grid.selectExpr("gender", "age", "l", f"m * (1.0D + {SITE_MEDIAN_STEP!r}D * {site}) AS m", "s")


# Columns of the driver tables the fixtures use.  Declaring them skips the
# schema-inference job on every read, and the scan reads only these.
READ_SCHEMAS = {
    "orders": T.StructType([
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]),
    "customer": T.StructType([T.StructField("c_custkey", T.LongType())]),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in READ_SCHEMAS:
        reader = reader.schema(READ_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(measurement, person) derived from ``orders`` and ``customer``."""
    return (measurement_from_orders(read_table(spark, sf_dir, "orders")),
            person_from_customer(read_table(spark, sf_dir, "customer")))
