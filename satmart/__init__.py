"""Service demand and saturation over any table of entity, period and quantity, on Spark."""

from satmart.settings import Settings

__all__ = ["Settings"]
