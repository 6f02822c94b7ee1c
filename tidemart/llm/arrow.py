"""Passing texts through Python in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


def values(column: pa.Array) -> list | pa.Array:
    if pa.types.is_struct(column.type):
        return column
    return (column.cast(pa.binary()) if pa.types.is_string(column.type) else column).to_pylist()


def map_batches(df: DataFrame, schema: str | StructType, each: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]]) -> DataFrame:
    """Run ``each`` over a partition's batches; batches come and go as dicts of columns.

    Text columns come as UTF-8 bytes (a null as None), so that nothing is decoded that need not be. Structs come and may
    go as they are, to be carried along.
    """
    kind: StructType = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns() -> Iterator[dict[str, list]]:
            for batch in batches:
                yield {name: values(column) for name, column in zip(batch.schema.names, batch.columns)}

        for out in each(columns()):
            arrays = [x if isinstance(x := out[f.name], pa.Array) else pa.array(x, f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(arrays, names=arrow.names)

    return df.mapInArrow(run, kind)
