"""Vectors as rows of packed blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def finite(column: str) -> Column:
    """True for a vector that is not null, has components, and has none that is null or not a finite number."""
    good = F.forall(column, lambda x: F.coalesce((F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return F.coalesce(good & (F.size(column) > 0), F.lit(False))


def packed(rows: DataFrame, keys: list[str], id_columns: list[str], dtype: str) -> DataFrame:
    """One row of (keys, ids, data) for each group of rows(keys, ids, v): the ids (longs, a row each) in order and the
    vectors as matrices of bytes.

    Groups must be of bounded size.
    """
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("ids", T.BinaryType()), T.StructField("data", T.BinaryType())])

    types = {"int": pa.int32(), "bigint": pa.int64()}
    types = {k: types[rows.schema[k].dataType.simpleString()] for k in keys}

    def run(table):
        ids = np.stack([table.column(c).to_numpy() for c in id_columns], 1)
        order = np.lexsort(ids.T[::-1])
        flat = pa.concat_arrays(table.column("v").chunks).flatten().to_numpy(zero_copy_only=False)
        matrix = flat.reshape(len(ids), -1)[order].astype(dtype)
        head = [pa.array([table.column(k)[0].as_py()], types[k]) for k in keys]
        return pa.Table.from_arrays([*head, pa.array([ids[order].astype(np.int64).tobytes()], pa.binary()), pa.array([matrix.tobytes()], pa.binary())], names=schema.names)

    return rows.select(*keys, *id_columns, "v").groupBy(*keys).applyInArrow(run, schema)
