"""Spark-native refinement of targeted mass-spectrometry signals."""

from peakloom.config import RefineParams

__all__ = ["RefineParams"]
