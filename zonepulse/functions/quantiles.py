"""Exact discrete percentiles kept inside the Spark plan.

``percentile_disc`` returns an element of the input (no interpolation), the
same value ``approxQuantile(..., relativeError=0.0)`` returns, and NULL on an
empty input instead of an empty list. Its aggregation buffer is a map of
distinct value -> frequency that is combined map-side, so for count-like
metrics (few distinct values) the final single-partition merge is tiny.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percentile_disc(column: str, q: float) -> Column:
    """Aggregate expression: exact discrete ``q``-quantile of ``column``."""
    if not 0.0 <= q <= 1.0:
        raise ValueError(f"quantile must be in [0, 1], got {q}")
    return F.expr(f"percentile_disc({float(q)!r}) WITHIN GROUP (ORDER BY `{column}`)")


def percentile_approx(column: str, q: float, relative_error: float) -> Column:
    """Aggregate expression: approximate ``q``-quantile with the given
    relative rank error (the in-plan form of ``approxQuantile``)."""
    return F.percentile_approx(F.col(column), float(q), max(1, int(round(1.0 / relative_error))))


def threshold_frame(
    df: DataFrame, column: str, q: float, name: str = "threshold", relative_error: float = 0.0
) -> DataFrame:
    """One-row frame with the ``q``-quantile, cast back to the column's
    type (so a count threshold stays an integer). ``relative_error`` 0 is
    exact (``percentile_disc``); a positive value uses a bounded sketch."""
    dtype = dict(df.dtypes)[column]
    agg = percentile_disc(column, q) if relative_error <= 0 else percentile_approx(column, q, relative_error)
    return df.agg(agg.cast(dtype).alias(name))


def threshold_value(df: DataFrame, column: str, q: float, relative_error: float = 0.0) -> Column:
    """Scalar-subquery column with the ``q``-quantile.

    Spark runs the subquery once per query and substitutes the value, so the
    filter stays a plain predicate: no cross join, no driver round-trip in
    user code.
    """
    return threshold_frame(df, column, q, relative_error=relative_error).scalar()
