"""Arrow UDFs that hold the Python objects of a few rows at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Rows of a slice, and bytes beyond which it is halved.
ROWS, BYTES = 64, 2 << 20


def pieces(columns: tuple[pa.Array, ...]) -> Iterator[tuple[pa.Array, ...]]:
    at = 0
    while at < len(columns[0]):
        n = ROWS
        while n > 1 and sum(c.slice(at, n).nbytes for c in columns) > BYTES:
            n //= 2
        yield tuple(c.slice(at, n) for c in columns)
        at += n


def by_slices(f: Callable, kind: str | T.DataType):
    """``f``, of one or more columns' values, as a UDF of rows.

    ``udf(..., useArrow=True)`` makes Python objects of all values and results
    of a batch, 10,000 rows of any size; here they are those of a slice, and a
    worker's memory does not grow with the rows that a batch holds.
    """
    arrow = to_arrow_type(T.DataType.fromDDL(kind) if isinstance(kind, str) else kind)

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            columns = (batch,) if isinstance(batch, pa.Array) else batch
            if len(columns[0]) == 0:
                yield pa.array([], arrow)
            for piece in pieces(columns):
                values = [c.to_pylist(maps_as_pydicts="lossy") for c in piece]
                yield pa.array([f(*row) for row in zip(*values, strict=True)], arrow)

    return F.arrow_udf(run, kind)
