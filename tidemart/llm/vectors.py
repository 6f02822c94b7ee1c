"""Vectors as whole numbers, and as matrices inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_numbers(df: DataFrame, scale: int, embedding: str, **keep: str) -> DataFrame:
    """Rows whose vector can be used, as ``x`` (floor(scale * component), long), its ``width``, and the columns ``keep`` names.

    Vectors that are null or empty or hold null or non-finite components go. A product beyond a long is the longest or
    the least long.
    """
    named = df.select(*[F.col(f"`{c}`").alias(name) for name, c in keep.items()], F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    fine = F.coalesce(~bad & (F.size("v") > 0), F.lit(False))
    x = F.transform("v", lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    return named.filter(fine).select(*keep, x.alias("x"), F.size("v").alias("width"))


def widths(rows: DataFrame) -> list[int]:
    """The lengths that vectors have: few, as vectors of one model have one."""
    return sorted(r.width for r in rows.select("width").distinct().collect())


def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1)


def fits(*bounds: int) -> bool:
    """Whether a product of these stays well inside a long."""
    product = 1
    for b in bounds:
        product *= int(b)
    return product < 1 << 62


def largest(x: np.ndarray) -> int:
    """The largest size of a component."""
    return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
