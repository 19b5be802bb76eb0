"""Rows of a key one after the other, in tasks that hold one key at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

Rows = list[tuple]


def grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, Rows]]:
    """(key, rows) of batches sorted by their first ``n_keys`` columns; a key may span batches."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if row[:n_keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:n_keys], []
            rows.append(row)
    if rows:
        yield key, rows


def by_key(frame: DataFrame, keys: Sequence[str], order: Sequence[str], work: Callable[[tuple, Rows], Iterator[tuple]], schema: str, batch: int = 4096) -> DataFrame:
    """``work(key, rows)`` for every key, its rows in the given order; much lighter than one grouped call a key.

    Rows reach ``work`` as tuples of the columns keys, order and rest. Only one
    key's rows are held at a time, so ``keys`` must name bounded groups.
    """
    rest = [c for c in frame.columns if c not in (*keys, *order)]
    placed = frame.select(*keys, *order, *rest).repartition(*keys).sortWithinPartitions(*keys, *order)
    empty = frame.sparkSession.createDataFrame([], schema)
    names, kinds = empty.columns, [_arrow(field.dataType) for field in empty.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: Rows) -> pa.RecordBatch:
            return pa.record_batch([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names)

        out: Rows = []
        for key, rows in grouped(batches, len(keys)):
            for row in work(key, rows):
                out.append(row)
                if len(out) >= batch:
                    yield packed(out)
                    out = []
        if out:
            yield packed(out)

    return placed.mapInArrow(run, schema)


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
