"""End-to-end z-score job (OP-D6): cohort -> lookup -> z -> records -> sink.

All sites run in one job: ``site_id`` is a column, and the sink writes one
partition folder per site.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anthro.constants import (BMI_CONCEPT_ID, DAYS_PER_MONTH, DEFAULT_LABEL_PREFIX,
                              DEFAULT_VERSION, ZSCORE_CONCEPT_ID)
from anthro.operators.cohort import check_unique, measurement_cohort, select_measurements
from anthro.operators.records import zscore_records
from anthro.operators.zscore import lms_parameters, with_zscore
from anthro.plans.inspect import plan_text
from anthro.sources.sinks import write_zscores


def bmi_zscore(measurement: DataFrame, person: DataFrame, grid, *,
               measurement_concept_id: int = BMI_CONCEPT_ID,
               zscore_concept_id: int = ZSCORE_CONCEPT_ID,
               days_per_month: float = DAYS_PER_MONTH,
               version: str = DEFAULT_VERSION,
               label_prefix: str = DEFAULT_LABEL_PREFIX,
               neighbor_rank: int = 1,
               drop_null_keys=(),
               strict: bool = False,
               site: str | None = None,
               hot_key_fraction: float | None = None,
               hot_key_strategy: str = "salt",
               method: str = "auto",
               require_unique_ids: bool = False,
               **bracket_opts) -> DataFrame:
    """BMI-for-age z-score records for every site (16 columns).

    ``neighbor_rank=1`` interpolates between the nearest grid ages (the
    documented intent); ``neighbor_rank=2`` between the second nearest,
    which is what the original job computes as run.  ``drop_null_keys``
    drops rows with a NULL in any of the named columns, reproducing the
    rows its nine-column re-join loses (see ``constants.REJOIN_KEYS``).
    ``site`` restricts the job to one ``site_id`` (filter pushed to the scan).
    ``method`` picks the lookup (see :func:`lms_parameters`).
    ``require_unique_ids`` first checks that ``measurement_id`` is unique
    among the selected measurements, within a site when person carries
    ``site_id`` (one aggregation job), and raises otherwise.

    Sites may use the same person ids: when ``person`` has a ``site_id``
    column the person join is on ``(site_id, person_id)``, and when ``grid``
    has one each site is looked up in its own grid.  Without them persons and
    grid are taken to be common to all sites.
    """
    if measurement.isStreaming and (hot_key_fraction or require_unique_ids):
        raise ValueError("hot_key_fraction and require_unique_ids need a batch input "
                         "(they count over the whole table first)")
    m = measurement if site is None else measurement.filter(F.col("site_id") == F.lit(site))
    if require_unique_ids:
        check_unique(select_measurements(m, measurement_concept_id),
                     ["site_id", "measurement_id"] if "site_id" in person.columns else "measurement_id")
    cohort = measurement_cohort(m, person, concept_id=measurement_concept_id,
                                days_per_month=days_per_month,
                                hot_key_fraction=hot_key_fraction,
                                hot_key_strategy=hot_key_strategy)
    if drop_null_keys:
        cohort = cohort.dropna(subset=list(drop_null_keys))
    withlms = lms_parameters(cohort, grid, k=neighbor_rank, method=method, **bracket_opts)
    z = with_zscore(withlms, strict=strict)
    return zscore_records(z, zscore_concept_id=zscore_concept_id, version=version,
                          label_prefix=label_prefix)


def run_zscore_job(measurement: DataFrame, person: DataFrame, grid, path: str | None = None,
                   *, table: str | None = None, explain_only: bool = False,
                   rebalance: bool = False, **params) -> str | None:
    """Build the job and write it (all sites, partitioned by ``site_id``).

    ``explain_only=True`` returns the physical plan and writes nothing.
    With ``site=...`` only that site's folder or partition of the output is
    replaced.  ``rebalance`` is passed to :func:`write_zscores`.
    Write errors are raised, not printed and swallowed.
    """
    df = bmi_zscore(measurement, person, grid, **params)
    if explain_only:
        return plan_text(df)
    write_zscores(df, path, table=table, rebalance=rebalance, site=params.get("site"))
    return None
