"""Helpers for Arrow-batched Python: the only way in which Python sees rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def map_rows(df: DataFrame, schema: T.StructType, rows: Callable[[Iterator[tuple]], Iterable[tuple]], batch: int = 20_000) -> DataFrame:
    """Runs `rows` once a partition over plain tuples; its tuples come back as columns of `schema`.

    Columns travel as Arrow batches; no pandas object is made and nothing is pickled a row at a time.
    """
    names = [f.name for f in schema]
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def source() -> Iterator[tuple]:
            for b in batches:
                if b.num_columns == 1:
                    yield from ((x,) for x in b.column(0).to_pylist())
                else:
                    yield from zip(*[c.to_pylist() for c in b.columns])

        def pack(buffer: list[tuple]) -> pa.RecordBatch:
            columns = zip(*buffer)
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, arrow)], names=names)

        buffer: list[tuple] = []
        for row in rows(source()):
            buffer.append(row)
            if len(buffer) >= batch:
                yield pack(buffer)
                buffer = []
        if buffer:
            yield pack(buffer)

    return df.mapInArrow(run, schema)
