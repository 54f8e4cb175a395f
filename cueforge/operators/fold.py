"""Ordered folds: a key's rows pass one after the other through a Python function with a small state.

Rows are partitioned by key and sorted inside the partition by Spark, which spills; the fold then streams Arrow batches and
keeps only its state, so a key of any length runs in bounded memory. Python is used since each step depends on the result of
the one before (a dropped cue, a closed window, a full volume), which window frames can't express.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


def ordered_fold(df: DataFrame, keys: list[str], order: list[str], columns: list[str], begin: Callable[[], Callable[..., list[tuple]]], result: str) -> DataFrame:
    """Rows of (keys, result columns).

    begin() gives a function for a new key; it takes a row's `columns` and returns rows of the result columns, and is called once more
    with no arguments when the key ends. Null keys form a key of their own; ties in `order` come in any order, so end it with a unique column.
    """
    kinds = StructType([df.schema[k] for k in keys] + list(_parse_datatype_string(result).fields))
    schema = to_arrow_schema(kinds)
    need = list(dict.fromkeys([*keys, *columns]))
    places, at = [need.index(k) for k in keys], [need.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, step, out = None, None, []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

        for b in batches:
            rows = [c.to_pylist() for c in b.columns]
            for row in zip(*rows, strict=True):
                own = tuple(row[i] for i in places)
                if step is None or own != key:
                    out += [key + r for r in step()] if step else []
                    key, step = own, begin()
                out += [key + r for r in step(*(row[i] for i in at))]
            if len(out) >= 5000:
                yield batch()
                out = []
        if step:
            out += [key + r for r in step()]
        if out:
            yield batch()

    # the order columns take part in the sort only
    staged = df.select(*need, *(F.col(c).alias(f"_o{i}") for i, c in enumerate(order)))
    # dealt by a hash of the keys: an exchange by the keys themselves is left out after a join on them, and adaptive execution, which
    # doesn't see that the fold needs whole keys, then reads the rows as they lie where it makes that join a broadcast
    staged = staged.repartition(F.xxhash64(*keys)).sortWithinPartitions(*keys, *(f"_o{i}" for i in range(len(order))))
    return staged.select(*need).mapInArrow(run, kinds)
