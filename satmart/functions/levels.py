"""Saturation levels of a ratio in percent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from satmart.settings import Settings

# The level names of each scheme, from low to high.
DOMAINS = {
    "binario": ("Normal", "Saturado"),
    "tres": ("Bajo", "Normal", "Saturado"),
    "cuatro": ("Bajo", "Normal", "Alto", "Critico"),
}


def level(ratio: Column, scheme: str, s: Settings = Settings()) -> Column:
    """Level of a ratio; null for a null or NaN ratio.

    Lower limits are inclusive, except that only what exceeds the top limit is critical.
    """
    if scheme == "binario":
        named = F.when(ratio >= s.normal, "Saturado").otherwise("Normal")
    elif scheme == "tres":
        named = (
            F.when(ratio < s.low, "Bajo").when(ratio < s.normal, "Normal").otherwise("Saturado")
        )
    elif scheme == "cuatro":
        named = (
            F.when(ratio < s.low, "Bajo")
            .when(ratio < s.normal, "Normal")
            .when(ratio <= s.high, "Alto")
            .otherwise("Critico")
        )
    else:
        raise ValueError(f"unknown level scheme: {scheme}")
    return F.when(ratio.isNotNull() & ~F.isnan(ratio), named)
