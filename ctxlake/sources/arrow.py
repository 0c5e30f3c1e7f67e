"""Run a small per-document Python function inside executor tasks."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BATCH_ROWS = 256
BATCH_CHARS = 1 << 20

# Ship our parse functions inside the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])


def freed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A task function that gives memory back to the system when it ends; Python workers stay for later tasks and would keep it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return task


def flat_map_documents(
    docs: DataFrame,
    parse: Callable[[str, str], Iterable[tuple]],
    schema: StructType,
) -> DataFrame:
    """``parse(file_path, content)`` yields output tuples; batches travel as Arrow.

    Spark bounds an incoming batch by bytes. Of it one document at a time becomes Python
    strings, and rows go out in batches of at most ``BATCH_ROWS`` rows and about
    ``BATCH_CHARS`` characters, so a task holds the same memory however much it reads.
    """
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack(rows):
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow_schema)], schema=arrow_schema
            )

        rows, chars = [], 0
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                for row in parse(path.as_py(), content.as_py()):
                    rows.append(row)
                    chars += sum(len(v) for v in row if isinstance(v, str))
                    if len(rows) >= BATCH_ROWS or chars >= BATCH_CHARS:
                        yield pack(rows)
                        rows, chars = [], 0
            batch = path = content = None  # else the next batch would be read beside this one
        if rows:
            yield pack(rows)

    return docs.select("file_path", "content").mapInArrow(freed(run), schema)
