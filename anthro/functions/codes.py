"""Code decoding and label columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from anthro.constants import (DEFAULT_LABEL_PREFIX, DEFAULT_VERSION, LABEL_TEMPLATE,
                              SEX_LABELS, SOURCE_VALUE_PREFIX)


def decode(code, mapping: dict) -> Column:
    """Searched CASE: ``code`` -> label for each mapping entry, else NULL."""
    code = F.col(code) if isinstance(code, str) else code
    out = None
    for k, v in mapping.items():
        out = (F.when(code == F.lit(k), F.lit(v)) if out is None
               else out.when(code == F.lit(k), F.lit(v)))
    return out.otherwise(F.lit(None).cast("string"))


def gender_decode(code) -> Column:
    """Sex concept id -> ``"male"`` / ``"female"`` / NULL."""
    return decode(code, SEX_LABELS)


def source_label(source_value, prefix: str = SOURCE_VALUE_PREFIX) -> Column:
    """``prefix || coalesce(source_value, '')`` (concat alone would give NULL)."""
    source_value = F.col(source_value) if isinstance(source_value, str) else source_value
    return F.concat(F.lit(prefix), F.coalesce(source_value, F.lit("")))


def provenance_label(version: str = DEFAULT_VERSION,
                     prefix: str = DEFAULT_LABEL_PREFIX) -> str:
    """Text written to ``measurement_source_value`` of each record."""
    return LABEL_TEMPLATE.format(prefix=prefix, version=version)
