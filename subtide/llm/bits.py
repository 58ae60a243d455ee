"""Bit tables of fixed size: rows that cannot meet a set of keys stay where they are.

A table says of every key of the set that it may be in it, and of most others that they are not. It has the same
size for any input, so tasks can hold it whole; with more keys than bits it lets everything pass, and a join decides
in any case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from subtide.llm.batch import mixed

BITS = 24
_PART = 1 << 13


def _slots(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys.astype(np.int64).view(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64)


def key_bits(keys: DataFrame, column: str) -> np.ndarray:
    """The table of a column of longs, made by the tasks; the driver gets ``2 ** BITS`` bits at most."""
    schema = pa.schema([("part", pa.int32()), ("bits", pa.binary())])
    kinds = "part int, bits binary"

    def parts(table: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(table), pa.int32()), pa.array([t.tobytes() for t in table.values()], pa.binary())], schema=schema)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((1 << BITS) // 8, np.uint8)
        for rows in batches:
            slot = _slots(rows.column(0).drop_null().to_numpy(zero_copy_only=False))
            np.bitwise_or.at(table, slot >> 3, (1 << (slot & 7)).astype(np.uint8))
        split = table.reshape(-1, _PART)
        yield parts({int(k): split[k] for k in np.flatnonzero(split.any(axis=1))})

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[int, np.ndarray] = {}
        for rows in batches:
            for part, bits in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                own = np.frombuffer(bits, np.uint8)
                table[part] = table[part] | own if part in table else own
        yield parts(table)

    marked = keys.selectExpr(f"cast({column} AS long)").mapInArrow(mark, kinds)
    out = np.zeros(((1 << BITS) // 8 // _PART, _PART), np.uint8)
    for row in marked.repartition("part").mapInArrow(unite, kinds).collect():
        out[row["part"]] |= np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def holds(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the set."""
    slot = _slots(keys)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
