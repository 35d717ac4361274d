"""Age arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from anthro.constants import DAYS_PER_MONTH

# Column metadata: the divisor with which an age column was computed.
DAYS_PER_MONTH_KEY = "days_per_month"


def age_in_months(at, birth, days_per_month: float = DAYS_PER_MONTH) -> Column:
    """Calendar days from ``birth`` to ``at`` divided by ``days_per_month``.

    ``datediff`` counts calendar-day boundaries (the time of day is
    ignored), like a SQL ``date_diff('day', ...)``: 23:59:59 to 00:00:01 is
    one day.  TIMESTAMP_NTZ and DATE columns have one calendar; TIMESTAMP
    columns are instants, whose calendar day is that of the session time
    zone (``spark.sql.session.timeZone``; the job's sessions use UTC).
    """
    at = F.col(at) if isinstance(at, str) else at
    birth = F.col(birth) if isinstance(birth, str) else birth
    return F.datediff(at, birth).cast("double") / F.lit(float(days_per_month))
