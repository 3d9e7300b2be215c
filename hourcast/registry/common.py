"""Spark-side shared inputs of the registered queries."""
from __future__ import annotations

from ..operators import clean as C
from ..operators import features as FT
from ..operators import split as S
from ..sources import adapters as A


def hourly_clean(spark, sf_dir):
    """hourly rows with casual + registered = cnt enforced."""
    return C.enforce_sum(A.hourly(spark, sf_dir))


def hourly_split(spark, sf_dir):
    """hourly_clean + sqrt target + 70/15/15 temporal split column."""
    return S.split(FT.transform_target(hourly_clean(spark, sf_dir)))
