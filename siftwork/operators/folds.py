"""Folds over rows in order, for decisions that rest on the ones before them.

Spark deals the rows by key and sorts them inside each partition (spilling, where it must); a fold then passes over the sorted rows once.
What it remembers belongs to the group at hand and is forgotten at its end, so memory does not grow with the
rows of a key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def fold_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], new_group: Callable[[], Callable], keep: Sequence[str], output: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of a group, in order, through ``new_group()(*values)``, made anew for each group of equal ``keys``.

    The call gives a tuple for ``output`` (name, type), or None to leave the row out; ``keep`` columns pass through. Values and
    outputs are ints, longs, strings or booleans.
    """
    kept = [(f.name, f.dataType.simpleString()) for f in df.schema if f.name in keep]
    kept.sort(key=lambda f: list(keep).index(f[0]))
    schema = pa.schema([pa.field(n, _ARROW[t]) for n, t in [*kept, *output]])
    n_keys, n_values = len(keys), len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, step = None, None
        for b in batches:
            columns = [b.column(c).to_pylist() for c in (*keys, *values)]
            rows, results = [], []
            for i, row in enumerate(zip(*columns)):
                if step is None or row[:n_keys] != group:
                    group, step = row[:n_keys], new_group()
                got = step(*row[n_keys:n_keys + n_values])
                if got is not None:
                    rows.append(i)
                    results.append(got)
            taken = b.select([n for n, _ in kept]).take(pa.array(rows, pa.int64()))
            made = [pa.array([r[j] for r in results], _ARROW[t]) for j, (_, t) in enumerate(output)]
            yield pa.RecordBatch.from_arrays([*taken.columns, *made], schema=schema)

    narrow = df.select(*dict.fromkeys([*keys, *order, *values, *keep]))
    dealt = narrow.repartition(*keys).sortWithinPartitions(*keys, *order)
    return dealt.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in [*kept, *output]))
