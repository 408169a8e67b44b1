"""Answers brought to the rows that asked, one key at a time and streamed."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _runs(batch: pa.RecordBatch, key: str) -> Iterator[tuple[Any, int, pa.RecordBatch]]:
    """Slices of a batch that agree in the key (a long) and the turn."""
    keys, turns = batch.column(key).to_numpy(), batch.column("_turn").to_numpy()
    edges = np.flatnonzero((np.diff(keys) != 0) | (np.diff(turns) != 0)) + 1
    for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)]):
        if end > start:
            yield keys[start], turns[start], batch.slice(start, end - start)


def meet(
    answers: DataFrame, rows: DataFrame, key: str, prepare: Callable[[pa.Table], Any],
    judge: Callable[[Any, pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str,
) -> DataFrame:
    """Stream `rows` past the `answers` of the same key.

    Both are dealt by `key`, a long without nulls; within a key the answers come first. `prepare`
    turns a key's answers (a table, without rows where there are none) into what `judge` looks up
    for each batch of that key's rows. A task holds the answers of one key and one batch of rows, so
    a key may hold any number of rows, but only as many answers as fit in memory.
    """
    both = answers.withColumn("_turn", F.lit(0)).unionByName(
        rows.withColumn("_turn", F.lit(1)), allowMissingColumns=True)
    own = [c for c in answers.columns if c != key]
    asked = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ready, empty = None, [], None, None
        for whole in batches:
            empty = whole.select(own).slice(0, 0) if empty is None else empty
            for value, turn, part in _runs(whole, key):
                if value != at:
                    at, held, ready = value, [], None
                if turn == 0:
                    held.append(part.select(own))
                    continue
                if ready is None:
                    ready = (prepare(pa.Table.from_batches(held or [empty])),)
                    held = []
                yield from judge(ready[0], part.select(asked))

    return both.repartition(key).sortWithinPartitions(key, "_turn").mapInArrow(run, schema)
