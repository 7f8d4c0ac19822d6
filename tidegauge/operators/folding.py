"""Aggregates written by the user: a zero, a step over rows and a merge of states.

Each task folds its rows into states and hands them over as rows of a written table, keyed
by the task's number.  States are then merged ``FAN_IN`` at a time in tasks, level by level,
so neither the driver nor one task ever takes the states of all tasks, also not for a key
that holds most rows.

Every task counts once: a state is the output row of its task, so what a failed or
speculative attempt produced is discarded with it, ``zero`` is called anew for each attempt,
and a merge that runs again reads the same written rows.  Merges keep the order of tasks.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidegauge.session import materialise, ship_package, shuffle_tasks

FAN_IN = 16
#: Keys whose states a task holds before it hands them over.
KEYS_IN_TASK = 100_000


@dataclass(frozen=True)
class UserAggregate:
    """``zero() -> state``, ``step(state, *values) -> state``, ``merge(a, b) -> state``.

    ``merge`` must be associative; states must survive pickling.  ``result`` turns the last
    state into a value of the SQL type ``result_type``.  With ``by_batch`` the step takes an
    Arrow record batch of the columns instead of one row's values (not with keys).
    """

    zero: Callable[[], Any]
    step: Callable[..., Any]
    merge: Callable[[Any, Any], Any]
    result_type: str
    result: Callable[[Any], Any] = lambda state: state
    by_batch: bool = False


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*[c.to_pylist() for c in batch.columns])


def _states(n_keys: int, how: UserAggregate, keys_in_task: int):
    """One row ``(*keys, place, state)`` per key and task; without keys, one per task with rows."""

    def table(states: dict, batch: pa.RecordBatch, place: int) -> pa.RecordBatch:
        keys = [pa.array([k[i] for k in states], batch.schema.field(i).type) for i in range(n_keys)]
        blobs = pa.array([pickle.dumps(s) for s in states.values()], pa.binary())
        return pa.RecordBatch.from_arrays(
            [*keys, pa.array([place] * len(states), pa.int64()), blobs], [f"k{i}" for i in range(n_keys)] + ["place", "state"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, states, batch = TaskContext.get().partitionId(), {}, None
        for batch in batches:
            if how.by_batch:
                states[()] = how.step(states[()] if states else how.zero(), batch)
                continue
            for row in _rows(batch):
                key = row[:n_keys]
                states[key] = how.step(states[key] if key in states else how.zero(), *row[n_keys:])
                if len(states) >= keys_in_task:
                    yield table(states, batch, place)
                    states = {}
        if states:
            yield table(states, batch, place)

    return fold


def _merged(n_keys: int, merge: Callable, fan_in: int, schema: pa.Schema):
    """Runs of states with the same key and group become one; rows come sorted by both and place."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((*r[:n_keys], r[n_keys] // fan_in, r[n_keys + 1]) for b in batches for r in _rows(b))
        out: list[tuple] = []
        for head, run in groupby(rows, key=lambda r: r[:-1]):
            state = reduce(merge, (pickle.loads(row[-1]) for row in run))
            out.append((*head, pickle.dumps(state)))
            if len(out) == 1000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    return join


def user_aggregate(
    df: DataFrame, columns: Sequence[str], how: UserAggregate, keys: Sequence[str] = (), into: str = "value",
    fan_in: int = FAN_IN, keys_in_task: int = KEYS_IN_TASK,
) -> DataFrame:
    """One row ``(*keys, into)`` per key; without keys one row, ``zero`` where there are no rows.

    Null keys are a group.  Keys must be hashable in Python (no arrays).
    """
    if how.by_batch and keys:
        raise ValueError("a step over batches takes no keys")
    spark = df.sparkSession
    ship_package(spark)
    given = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)])
    names = [f"k{i}" for i in range(len(keys))]
    key_fields = [T.StructField(n, given.schema[n].dataType) for n in names]
    schema = T.StructType([*key_fields, T.StructField("place", T.LongType()), T.StructField("state", T.BinaryType())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    level = _merged(len(names), how.merge, fan_in, arrow)
    states = materialise(given.mapInArrow(_states(len(names), how, keys_in_task), schema), "states")
    last = states.agg(F.max("place")).first()[0]
    while last is not None:
        group = F.expr(f"place div {fan_in}")
        dealt = states.repartition(shuffle_tasks(spark), *names, group).sortWithinPartitions(*names, "place")
        states = materialise(dealt.mapInArrow(level, schema), "states")
        last = last // fan_in or None  # at place 0 every key has one state
    result = T.StructType([*key_fields, T.StructField(into, T.DataType.fromDDL(how.result_type))])
    kind = to_arrow_type(result[into].dataType)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [how.result(pickle.loads(s)) for s in batch.column(len(names) + 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(values, kind)], [*names, into])

    if not keys and states.isEmpty():
        nothing = spark.createDataFrame([(0, pickle.dumps(how.zero()))], schema)
        return nothing.mapInArrow(finish, result)
    out = states.mapInArrow(finish, result)
    return out.withColumnsRenamed(dict(zip(names, keys)))
