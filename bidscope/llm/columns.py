"""Adding columns to a table batch by batch."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.llm.words import SLICE_BYTES, slices


def require(df: DataFrame, *names: str) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {', '.join(df.columns)}")


ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of simple columns and arrays of them."""
    fields = (c.split() for c in ddl.split(", "))
    return pa.schema([(n, pa.list_(ARROW[t[6:-1]]) if t.startswith("array<") else ARROW[t]) for n, t in fields])


#: Bytes that are broadcast; more are shuffled.
SMALL = 64 << 20


def _bytes(field: T.StructField) -> Column:
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(kind, T.ArrayType):
        return 32 * F.greatest(F.coalesce(F.size(column), F.lit(0)), F.lit(0))
    return F.lit(64 if isinstance(kind, T.StructType) else 8)


def known_small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """For a join: broadcast a written table if its bytes, summed over all
    rows and 24 more for each, are few."""
    size = df.agg(F.sum(sum((_bytes(f) for f in df.schema), F.lit(24)).cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= most else df


def give_back() -> None:
    """Free memory goes back to the system at the end of a task: the worker
    lives on, and the next task may be another operator's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of the GNU C library
    if trim is not None:
        trim(0)


def with_columns(df: DataFrame, text: str, added: str, make: Callable[[pa.RecordBatch], list],
                 keep: list[str] | None = None, done: Callable[[], None] = lambda: None, most: int = SLICE_BYTES) -> DataFrame:
    """``df`` (or its columns ``keep``) with the columns ``added`` (a DDL
    schema), which ``make`` returns for a slice of at most ``most`` bytes of
    ``text``.  A column of ``df`` that has the name of an added one is
    replaced.  ``done`` is called when a task ends.  One pass, no shuffle."""
    new = T.StructType.fromDDL(added)
    names = [f.name for f in new]
    stay = [c for c in (df.columns if keep is None else keep) if c not in names]
    schema = T.StructType([df.schema[c] for c in stay] + list(new))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, most):
                columns = [part.column(c) for c in stay] + [x if isinstance(x, pa.Array) else pa.array(x) for x in make(part)]
                yield pa.RecordBatch.from_arrays(columns, stay + names)
        done()
        give_back()

    need = list(dict.fromkeys([*stay, text]))
    return df.select(*need).mapInArrow(run, schema)
