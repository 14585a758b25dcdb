"""Kubernetes resource quantities as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes of the Kubernetes quantity format.
SUFFIX_FACTORS = {
    "n": 1e-9,
    "u": 1e-6,
    "m": 1e-3,
    "": 1.0,
    "k": 1e3,
    "M": 1e6,
    "G": 1e9,
    "T": 1e12,
    "P": 1e15,
    "Ki": 1024.0,
    "Mi": 1024.0**2,
    "Gi": 1024.0**3,
    "Ti": 1024.0**4,
    "Pi": 1024.0**5,
}

_QUANTITY = r"^([0-9]+(?:\.[0-9]+)?)([A-Za-z]*)$"


def quantity(text: Column) -> Column:
    """``100m`` is 0.1, ``64Mi`` is 64 * 1024 * 1024; NULL when malformed."""
    number = F.regexp_extract(text, _QUANTITY, 1).try_cast("double")
    suffix = F.regexp_extract(text, _QUANTITY, 2)
    factor = F.lit(None).cast("double")
    for name, value in SUFFIX_FACTORS.items():
        factor = F.when(suffix == name, F.lit(value)).otherwise(factor)
    return number * factor
