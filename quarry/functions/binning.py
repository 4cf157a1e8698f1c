"""Value -> label bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucketize(value: Column | str, edges: Sequence[float], labels: Sequence[str],
              closed: str = "right", default: str | None = None) -> Column:
    """Label of the bin holding ``value``.

    ``closed="right"``: bins (-inf, e1], (e1, e2], ..., (ek, inf)
    ``closed="left"`` : bins (-inf, e1), [e1, e2), ..., [ek, inf)
    A null value gets ``default`` (None keeps it null, so callers can drop it).
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    if closed not in ("right", "left"):
        raise ValueError("closed must be 'right' or 'left'")
    v = F.col(value) if isinstance(value, str) else value
    expr = None
    for edge, label in zip(edges, labels):
        cond = v <= F.lit(edge) if closed == "right" else v < F.lit(edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = expr.when(v.isNotNull(), F.lit(labels[-1]))
    return expr.otherwise(F.lit(default)) if default is not None else expr
