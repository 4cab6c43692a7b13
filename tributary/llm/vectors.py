"""Integer vectors from tables of embeddings, and columns of them as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.session import materialize


def integer_vectors(rows: DataFrame, vector_col: str, scale: int, **columns: Column) -> DataFrame:
    """The given ``columns`` with ``vec``, floor(``scale`` * x) of each component as a long, its length ``dim`` and a number ``row``.

    Rows whose vector is null, or holds a null or non-finite component, are left out; so are rows with a null in one of ``columns``.
    What doesn't fit a long becomes the nearest one that does. The table is written once, so that a row keeps its number.
    """

    def usable(x: Column) -> Column:
        return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))

    wide = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    picked = rows.select(*[c.alias(n) for n, c in columns.items()], wide.alias("wide"))
    good = picked.dropna().where(F.forall("wide", usable))
    out = good.select(*columns, F.transform("wide", lambda x: F.floor(x * scale)).alias("vec"), F.size("wide").alias("dim"))
    return materialize(out.withColumn("row", F.monotonically_increasing_id()), "vectors")


def matrix_of(lists: pa.Array | pa.ChunkedArray, kind: type = np.int64) -> np.ndarray:
    """Lists of one length as rows."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(lists), len(flat) // max(len(lists), 1))
