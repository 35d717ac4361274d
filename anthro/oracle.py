"""Reference SQL for every registered query, for the DuckDB check.

Each statement derives the measurement and person tables from ``orders``
and ``customer`` by the FIXTURES.md rules, writes the grid as a VALUES
list generated from the same rule as the Spark side, and computes the
lookup the *plain* way -- two range joins with ``row_number`` windows and a
re-join of the halves, as the original job does -- so it checks the
bracket join by an independent plan.

Only z (``pow``/``ln``, whose last bit may differ between the JVM and
DuckDB) is rounded to 6 decimals on both sides.  Age and interpolated
L/M/S are plain IEEE arithmetic in the same order on both sides, hence
bit-equal; rounding them would only create ties (an interpolation at
``frac = 0.5`` between 6-decimal grid values ends in an exact 5).

``measurement_date`` (a DATE in the records) is compared as its midnight
TIMESTAMP: pandas turns a DuckDB DATE into ``datetime64`` but a Spark DATE
into ``datetime.date``, and the two would never hash alike.
"""

from __future__ import annotations

from anthro.constants import (BMI_CONCEPT_ID, DAYS_PER_MONTH, DEFAULT_LABEL_PREFIX,
                              DEFAULT_VERSION, DERIVED_TYPE_CONCEPT_ID, FEMALE_CONCEPT_ID,
                              MALE_CONCEPT_ID, OUTPUT_SOURCE_CONCEPT_ID, OUTPUT_UNIT_CONCEPT_ID,
                              OUTPUT_UNIT_SOURCE_VALUE, REJOIN_KEYS, SOURCE_VALUE_PREFIX,
                              UNIT_KG_PER_M2, ZSCORE_CONCEPT_ID)
from anthro.functions.codes import provenance_label
from anthro.sources import fixtures as fx
from anthro.sources.grids import rule_grid_rows

ROUND = 6


def _measurement_sql(hot_person: bool = False) -> str:
    person = f"CASE WHEN o_orderkey % {fx.HOT_EVERY} = 0 THEN CAST({fx.HOT_PERSON_ID} AS BIGINT) ELSE o_custkey END" if hot_person else "o_custkey"
    base = f"(10.0 + o_totalprice / {fx.PRICE_DIVISOR})"
    return f"""measurement AS (
  SELECT o_orderkey AS measurement_id,
         {person} AS person_id,
         CAST(CASE WHEN o_orderkey % 11 = 0 THEN {fx.OTHER_CONCEPT_ID} ELSE {BMI_CONCEPT_ID} END AS INTEGER) AS measurement_concept_id,
         CAST(CASE WHEN o_orderkey % 19 = 0 THEN {fx.OTHER_TYPE_CONCEPT_ID} ELSE {DERIVED_TYPE_CONCEPT_ID} END AS INTEGER) AS measurement_type_concept_id,
         CAST(CASE WHEN o_orderkey % 17 = 0 THEN {fx.OTHER_UNIT_CONCEPT_ID} ELSE {UNIT_KG_PER_M2} END AS INTEGER) AS unit_concept_id,
         CASE WHEN o_orderkey % 13 = 0 THEN CAST(NULL AS DOUBLE)
              WHEN o_orderkey % 37 = 0 THEN CAST(0.0 AS DOUBLE)
              WHEN o_orderkey % 41 = 0 THEN -{base}
              ELSE {base} END AS value_as_number,
         CASE WHEN o_orderkey % 7 = 0 THEN CAST(NULL AS VARCHAR) ELSE o_orderpriority END AS value_source_value,
         CASE WHEN o_orderkey % 23 = 0 THEN CAST(NULL AS TIMESTAMP) ELSE CAST(o_orderdate AS TIMESTAMP) END AS measurement_datetime,
         'site_' || CAST(o_custkey % {fx.N_SITES} AS VARCHAR) AS site_id,
         CAST(CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey % 7 END AS BIGINT) AS provider_id,
         CAST(CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderkey END AS BIGINT) AS visit_occurrence_id
  FROM orders)"""


def _person_sql() -> str:
    return f"""person AS (
  SELECT c_custkey AS person_id,
         CAST(CASE WHEN c_custkey % 43 = 0 THEN {fx.UNKNOWN_SEX_CONCEPT_ID}
                   WHEN c_custkey % 2 = 0 THEN {MALE_CONCEPT_ID}
                   ELSE {FEMALE_CONCEPT_ID} END AS INTEGER) AS gender_concept_id,
         CASE WHEN c_custkey % 31 = 0 THEN CAST(NULL AS TIMESTAMP)
              ELSE CAST(DATE '{fx.BIRTH_BASE_DATE}' + CAST((c_custkey * {fx.BIRTH_DAY_STEP}) % {fx.BIRTH_DAY_RANGE} AS INTEGER) AS TIMESTAMP)
         END AS birth_datetime
  FROM customer)"""


def _person_by_site_sql() -> str:
    return f"""person AS (
  SELECT c_custkey AS person_id, 'site_' || CAST(site_no AS VARCHAR) AS site_id,
         CAST(CASE WHEN c_custkey % 43 = 0 THEN {fx.UNKNOWN_SEX_CONCEPT_ID}
                   WHEN c_custkey % 2 = 0 THEN {MALE_CONCEPT_ID}
                   ELSE {FEMALE_CONCEPT_ID} END AS INTEGER) AS gender_concept_id,
         CASE WHEN c_custkey % 31 = 0 THEN CAST(NULL AS TIMESTAMP)
              ELSE CAST(DATE '{fx.BIRTH_BASE_DATE}' + CAST((c_custkey * {fx.BIRTH_DAY_STEP}) % {fx.BIRTH_DAY_RANGE} + {fx.SITE_BIRTH_STEP} * site_no AS INTEGER) AS TIMESTAMP)
         END AS birth_datetime
  FROM customer, (VALUES {", ".join(f"({i})" for i in range(fx.N_SITES))}) AS sites(site_no))"""


def _grid_sql(zero_l: tuple[float, float] | None = None) -> str:
    rows = ",\n    ".join(f"('{g}', {a!r}, {l!r}, {m!r}, {s!r})" for g, a, l, m, s in rule_grid_rows(zero_l=zero_l))
    return f"""grid_raw(gender, age, l, m, s) AS (VALUES
    {rows}),
grid AS (
  SELECT gender, CAST(age AS DOUBLE) AS age, CAST(l AS DOUBLE) AS l,
         CAST(m AS DOUBLE) AS m, CAST(s AS DOUBLE) AS s FROM grid_raw)"""


def _selected_sql(concept_id: int = BMI_CONCEPT_ID) -> str:
    return f"""selected AS (
  SELECT * FROM measurement
  WHERE measurement_concept_id = {concept_id} AND value_as_number IS NOT NULL
    AND unit_concept_id = {UNIT_KG_PER_M2} AND measurement_type_concept_id = {DERIVED_TYPE_CONCEPT_ID}
    AND measurement_datetime IS NOT NULL)"""


def _selected_person_sql() -> str:
    return f"""selected_person AS (
  SELECT * FROM person
  WHERE gender_concept_id IN ({MALE_CONCEPT_ID}, {FEMALE_CONCEPT_ID}) AND birth_datetime IS NOT NULL)"""


def _gender_case(col: str) -> str:
    return (f"CASE WHEN {col} = {MALE_CONCEPT_ID} THEN 'male' "
            f"WHEN {col} = {FEMALE_CONCEPT_ID} THEN 'female' ELSE CAST(NULL AS VARCHAR) END")


def _age_expr(at: str, birth: str, days_per_month: float) -> str:
    return f"CAST(date_diff('day', {birth}, {at}) AS DOUBLE) / {float(days_per_month)!r}"


def _cohort_sql(days_per_month: float = DAYS_PER_MONTH, concept_id: int = BMI_CONCEPT_ID,
                site: str | None = None, by_site: bool = False) -> str:
    keys = " AND m.site_id = p.site_id" if by_site else ""
    site_filter = f"\n  WHERE m.site_id = '{site}'" if site else ""
    return f"""{_selected_sql(concept_id)},
{_selected_person_sql()},
cohort AS (
  SELECT m.measurement_id, m.person_id,
         m.value_as_number AS bmi_value,
         m.value_source_value AS bmi_source_value,
         {_age_expr('m.measurement_datetime', 'p.birth_datetime', days_per_month)} AS age_in_months,
         {_gender_case('p.gender_concept_id')} AS gender,
         m.measurement_datetime, p.birth_datetime, m.site_id, m.provider_id, m.visit_occurrence_id
  FROM selected m JOIN selected_person p ON m.person_id = p.person_id{keys}{site_filter})"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


def _base(**cohort_kw) -> list[str]:
    return [_measurement_sql(), _person_sql(), _grid_sql(), _cohort_sql(**cohort_kw)]


COHORT_COLS = ("measurement_id, person_id, bmi_value, bmi_source_value, age_in_months, gender, "
               "measurement_datetime, birth_datetime, site_id, provider_id, visit_occurrence_id")


def _r(expr: str) -> str:
    return f"round({expr}, {ROUND})"


def _cohort_select(prefix: str = "c.") -> str:
    cols = [c.strip() for c in COHORT_COLS.split(",")]
    return ", ".join(f"{prefix}{c}" for c in cols)


def _halves_sql(k: int, src: str = "cohort") -> str:
    """The original plan: one range join + row_number per side (left joins)."""
    return f"""lower_half AS (
  SELECT c.*, g.age AS lower_age, g.l AS l_lo, g.m AS m_lo, g.s AS s_lo,
         row_number() OVER (PARTITION BY c.measurement_id ORDER BY g.age DESC) AS rn
  FROM {src} c LEFT JOIN grid g ON g.gender = c.gender AND g.age <= c.age_in_months
  QUALIFY rn = {k}),
upper_half AS (
  SELECT c.*, g.age AS upper_age, g.l AS l_hi, g.m AS m_hi, g.s AS s_hi,
         row_number() OVER (PARTITION BY c.measurement_id ORDER BY g.age ASC) AS rn
  FROM {src} c LEFT JOIN grid g ON g.gender = c.gender AND g.age >= c.age_in_months
  QUALIFY rn = {k})"""


def _both_sql(k: int, src: str = "cohort", null_safe: bool = True) -> str:
    """Lower and upper halves side by side, one row per input row."""
    if null_safe:
        on = "lo.measurement_id = hi.measurement_id"
    else:
        on = " AND ".join(f"lo.{c} = hi.{c}" for c in REJOIN_KEYS)
    return f"""{_halves_sql(k, src)},
both_sides AS (
  SELECT lo.*, hi.upper_age, hi.l_hi, hi.m_hi, hi.s_hi
  FROM lower_half lo JOIN upper_half hi ON {on})"""


def _interp(v: str) -> str:
    frac = "(age_in_months - lower_age) / (upper_age - lower_age)"
    return f"CASE WHEN upper_age = lower_age THEN {v}_lo ELSE {v}_lo + {frac} * ({v}_hi - {v}_lo) END"


def _lms_sql(k: int, src: str = "cohort", null_safe: bool = True) -> str:
    return f"""{_both_sql(k, src, null_safe)},
with_lms AS (
  SELECT *, {_interp('l')} AS l, {_interp('m')} AS m, {_interp('s')} AS s
  FROM both_sides WHERE lower_age IS NOT NULL AND upper_age IS NOT NULL)"""


def _z_expr(zero_guard: bool = True) -> str:
    ratio = "(bmi_value / NULLIF(m, 0))"
    z = (f"CASE WHEN l <> 0 THEN (pow({ratio}, l) - 1) / NULLIF(l * s, 0) "
         f"ELSE ln(CASE WHEN {ratio} > 0 THEN {ratio} END) / NULLIF(s, 0) END")
    if zero_guard:
        z = f"CASE WHEN bmi_value = 0 AND l < 0 THEN CAST(NULL AS DOUBLE) ELSE {z} END"
    return z


def _z_sql(k: int, src: str = "cohort", strict: bool = False, null_safe: bool = True) -> str:
    if strict:
        keep = "bmi_value > 0 AND m > 0 AND s > 0 AND abs(z_score) <= 1e15"
    else:
        keep = "isfinite(z_score)"
    return f"""{_lms_sql(k, src, null_safe)},
with_z AS (
  SELECT * FROM (SELECT *, {_z_expr(zero_guard=not strict)} AS z_score FROM with_lms)
  WHERE {keep})"""


def _records_select(version: str = DEFAULT_VERSION, label_prefix: str = DEFAULT_LABEL_PREFIX,
                    zscore_concept_id: int = ZSCORE_CONCEPT_ID) -> str:
    return f"""SELECT measurement_id, person_id,
       CAST({zscore_concept_id} AS INTEGER) AS measurement_concept_id,
       CAST(CAST(measurement_datetime AS DATE) AS TIMESTAMP) AS measurement_date,
       measurement_datetime,
       CAST({DERIVED_TYPE_CONCEPT_ID} AS INTEGER) AS measurement_type_concept_id,
       CAST({OUTPUT_UNIT_CONCEPT_ID} AS INTEGER) AS unit_concept_id,
       '{OUTPUT_UNIT_SOURCE_VALUE}' AS unit_source_value,
       {_r('z_score')} AS value_as_number,
       '{SOURCE_VALUE_PREFIX}' || coalesce(bmi_source_value, '') AS value_source_value,
       '{provenance_label(version, label_prefix)}' AS measurement_source_value,
       CAST({OUTPUT_SOURCE_CONCEPT_ID} AS INTEGER) AS measurement_source_concept_id,
       age_in_months AS measurement_age_in_months,
       site_id, provider_id, visit_occurrence_id
FROM with_z"""


def records_sql(k: int = 1, drop_null_keys=(), site: str | None = None,
                days_per_month: float = DAYS_PER_MONTH, version: str = DEFAULT_VERSION,
                label_prefix: str = DEFAULT_LABEL_PREFIX,
                zscore_concept_id: int = ZSCORE_CONCEPT_ID, strict: bool = False) -> str:
    ctes = _base(days_per_month=days_per_month, site=site)
    src = "cohort"
    null_safe = True
    if drop_null_keys:
        # The original re-join: plain equality on the nine keys drops NULLs.
        null_safe = False
        if set(drop_null_keys) != set(REJOIN_KEYS):
            ctes.append("keyed AS (SELECT * FROM cohort WHERE "
                        + " AND ".join(f"{c} IS NOT NULL" for c in drop_null_keys) + ")")
            src, null_safe = "keyed", True
    ctes.append(_z_sql(k, src, strict=strict, null_safe=null_safe))
    return _with(*ctes) + "\n" + _records_select(version, label_prefix, zscore_concept_id)


def oracle_sql() -> dict[str, str]:
    base = _base()
    cohort_out = f"SELECT {_cohort_select()} FROM cohort c"
    lookup_cols = "lower_age, upper_age, l_lo, l_hi, m_lo, m_hi, s_lo, s_hi"
    q = {}
    q["scan_measurement"] = _with(_measurement_sql()) + "\nSELECT * FROM measurement"
    q["filter_measurement"] = _with(_measurement_sql(), _selected_sql()) + "\nSELECT * FROM selected"
    q["filter_person"] = _with(_person_sql(), _selected_person_sql()) + "\nSELECT * FROM selected_person"
    q["gender_decode"] = (_with(_person_sql()) + "\nSELECT person_id, gender_concept_id, "
                          f"{_gender_case('gender_concept_id')} AS gender FROM person")
    q["age_in_months"] = (_with(_measurement_sql(), _person_sql()) + "\nSELECT m.measurement_id, m.person_id, "
                          "m.measurement_datetime, p.birth_datetime, "
                          f"{_age_expr('m.measurement_datetime', 'p.birth_datetime', DAYS_PER_MONTH)} AS age_in_months\n"
                          "FROM measurement m JOIN person p ON m.person_id = p.person_id")
    q["source_label"] = (_with(_measurement_sql()) + "\nSELECT measurement_id, value_source_value, "
                         f"'{SOURCE_VALUE_PREFIX}' || coalesce(value_source_value, '') AS source_label FROM measurement")
    q["measurement_cohort"] = _with(*base) + "\n" + cohort_out
    q["bracket_lower"] = (_with(*base, _halves_sql(1)) + f"\nSELECT {_cohort_select()}, "
                          "c.lower_age, c.l_lo, c.m_lo, c.s_lo FROM lower_half c")
    q["bracket_upper"] = (_with(*base, _halves_sql(1)) + f"\nSELECT {_cohort_select()}, "
                          "c.upper_age, c.l_hi, c.m_hi, c.s_hi FROM upper_half c")
    for side, keep in (("lower", "lo"), ("upper", "hi")):
        q[f"bracket_{side}_rank2"] = (_with(*base, _halves_sql(2)) + f"\nSELECT {_cohort_select()}, c.{side}_age, c.l_{keep}, c.m_{keep}, c.s_{keep} "
                                      f"FROM {side}_half c WHERE c.{side}_age IS NOT NULL")
    q["bracket_rejoin_keys"] = (_with(*base, _both_sql(1, null_safe=False))
                                + f"\nSELECT {_cohort_select()}, {lookup_cols} FROM both_sides c")
    for name, k in (("bracket_lookup", 1), ("bracket_lookup_rank2", 2)):
        q[name] = (_with(*base, _both_sql(k)) + f"\nSELECT {_cohort_select()}, {lookup_cols} "
                   "FROM both_sides c WHERE lower_age IS NOT NULL AND upper_age IS NOT NULL")
    q["bracket_lookup_salted"] = q["bracket_lookup"]
    q["lms_interpolate"] = (_with(*base, _lms_sql(1)) + f"\nSELECT {_cohort_select()}, lower_age, upper_age, "
                            "l, m, s FROM with_lms c")
    zcols = f"measurement_id, person_id, bmi_value, age_in_months, gender, l, m, s, {_r('z_score')} AS z_score"
    q["lms_zscore"] = _with(*base, _z_sql(1)) + f"\nSELECT {zcols} FROM with_z"
    q["zscore_strict"] = _with(*base, _z_sql(1, strict=True)) + f"\nSELECT {zcols} FROM with_z"
    q["zscore_records"] = records_sql(1, **RECORDS_PARAMS)
    q["bmi_zscore"] = records_sql(1)
    q["bmi_zscore_literal"] = records_sql(2, drop_null_keys=REJOIN_KEYS)
    q["zscore_by_site"] = records_sql(1, site=BY_SITE)
    hot = [_measurement_sql(hot_person=True), _person_sql(), _grid_sql(), _cohort_sql()]
    q["zscore_hot_key_split"] = _with(*hot, _z_sql(1)) + "\n" + _records_select()
    multi = [_measurement_sql(), _person_by_site_sql(), _grid_sql(), _cohort_sql(by_site=True)]
    q["cohort_multi_site"] = _with(*multi) + "\n" + cohort_out
    log_form = [_measurement_sql(), _person_sql(), _grid_sql(ZERO_L_AGES), _cohort_sql()]
    q["lms_zscore_log_form"] = _with(*log_form, _z_sql(1)) + f"\nSELECT {zcols} FROM with_z"
    q["cohort_multi_site_bucketed"] = q["cohort_multi_site"]
    q["bracket_lookup_sorted"] = q["bracket_lookup"]
    same = " AND ".join(f"lo.{c} IS NOT DISTINCT FROM hi.{c}" for c in REJOIN_KEYS)
    q["bracket_rejoin_nullsafe"] = (_with(*base, _halves_sql(1)) + f"\nSELECT {_cohort_select('lo.')}, lo.lower_age, hi.upper_age, lo.l_lo, hi.l_hi, lo.m_lo, hi.m_hi, "
                                    f"lo.s_lo, hi.s_hi FROM lower_half lo JOIN upper_half hi ON {same}")
    numbered = ", ".join(f"row_number() OVER (PARTITION BY person_id ORDER BY measurement_datetime {d}, measurement_id {d}) AS {n}" for d, n in (("ASC", "up"), ("DESC", "down")))
    kth = "SELECT person_id, measurement_id, measurement_datetime, value_as_number, {} AS from_last FROM numbered WHERE {} = 2"
    q["kth_measurement_per_person"] = (_with(_measurement_sql(hot_person=True), f"numbered AS (SELECT *, {numbered} FROM measurement WHERE measurement_datetime IS NOT NULL)")
                                       + "\n" + kth.format("false", "up") + "\nUNION ALL\n" + kth.format("true", "down"))
    site_grids = _grid_sql().rsplit("grid AS (", 1)[0] + f"""grid AS (
  SELECT 'site_' || CAST(site_no AS VARCHAR) AS site_id, gender, CAST(age AS DOUBLE) AS age, CAST(l AS DOUBLE) AS l,
         CAST(m AS DOUBLE) * (CAST(1 AS DOUBLE) + CAST({fx.SITE_MEDIAN_STEP} AS DOUBLE) * site_no) AS m, CAST(s AS DOUBLE) AS s
  FROM grid_raw, (VALUES {", ".join(f"({i})" for i in range(fx.N_SITES))}) AS sites(site_no))"""
    by_site = [c.replace("g.gender = c.gender", "g.gender = c.gender AND g.site_id = c.site_id") for c in (_z_sql(1),)]
    q["zscore_site_grids"] = _with(_measurement_sql(), _person_sql(), site_grids, _cohort_sql(), *by_site) + "\n" + _records_select()
    q["write_snapshot_roundtrip"] = q["bmi_zscore"]
    q["write_table_roundtrip"] = q["bmi_zscore"]
    q["bmi_zscore_bracket"] = q["bmi_zscore"]
    q["write_roundtrip"] = q["bmi_zscore"]
    q["zscore_stream"] = q["bmi_zscore"]
    return q


# Parameters of the ``zscore_records`` query: every job parameter moved off
# its default, so the records show each one.
RECORDS_PARAMS = dict(days_per_month=30.4375, version="v2.1", label_prefix="Synthetic grid",
                      zscore_concept_id=2000000044)
BY_SITE = "site_0"
# Ages at which the grid of ``lms_zscore_log_form`` has L = 0.
ZERO_L_AGES = (60.0, 140.0)
