"""Arrow batches in, Arrow batches out: the frame of the operators that run Python on texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows of an Arrow batch that holds whole texts or shingle sets, some KB each; Spark's 10 000 are tens of MB, several times.
TEXT_ROWS = 500

Make = Callable[[], Callable[[list], list[list]]]


def map_values(df: DataFrame, column: str, added: T.StructType, make: Make, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns but ``column`` by default) and the ``added`` columns that ``make()`` computes.

    ``make`` runs once in each task; what it returns takes a batch's values of
    ``column`` and gives one list per added column. A kept column whose name
    is also that of an added one is replaced by it. Rows are neither moved nor
    dropped, so a lost executor only repeats its own splits.
    """
    names = {f.name.lower() for f in added.fields}
    kept = [c for c in (keep if keep is not None else df.columns) if c.lower() not in names and (keep is not None or c != column)]
    source = df.select(*[df[c] for c in kept], df[column].alias("__value"))
    schema = T.StructType([source.schema[c] for c in kept] + added.fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            found = apply(batch.column(len(kept)).to_pylist())
            columns = [batch.column(i) for i in range(len(kept))]
            columns += [pa.array(v, type=arrow.field(len(kept) + i).type) for i, v in enumerate(found)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return source.mapInArrow(run, schema)
