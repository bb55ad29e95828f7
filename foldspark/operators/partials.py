"""Sums of arrays that tasks return, added level by level.

A kernel returns one row per key and task: (key, lane, parts), ``lane`` being the
task's number and ``parts`` an array of doubles. Adding the arrays cell by cell in
an aggregate costs an expression a cell; adding all of them at once holds every
task's array in one task. Here neighbouring lanes are added in groups of bounded
size until one lane is left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

SCHEMA = "key int, lane int, parts array<double>"
#: Doubles that the arrays of one task, or of one group of tasks, may hold.
HELD = 1 << 25


def partial_rows(totals: dict[int, np.ndarray]):
    """What a task gives: a batch per key."""
    lane = TaskContext.get().partitionId()
    for key, total in totals.items():
        yield pa.RecordBatch.from_pydict(
            {
                "key": pa.array([key], pa.int32()),
                "lane": pa.array([lane], pa.int32()),
                "parts": pa.array([total], pa.list_(pa.float64())),
            }
        )


def _added(table: pa.Table) -> pa.Table:
    parts = table.column("parts").combine_chunks()
    # by lane, so that the same tasks give the same sum
    order = np.argsort(table.column("lane").to_numpy(), kind="stable")
    total = parts.flatten().to_numpy().reshape(len(parts), -1)[order].sum(axis=0)
    return pa.table(
        {
            "key": table.column("key").slice(0, 1),
            "lane": pa.array([int(table.column("lane")[0].as_py())], pa.int32()),
            "parts": pa.array([total], pa.list_(pa.float64())),
        }
    )


def tasks_of(rows: DataFrame) -> int:
    """Number of partitions of a kept frame; fills the cache."""
    return (rows.select(F.spark_partition_id().alias("p")).agg(F.max("p")).first()[0] or 0) + 1


def tree_sum(parts: DataFrame, largest: int, tasks: int) -> dict[int, np.ndarray]:
    """The sum of every key's arrays, the longest of which has ``largest`` doubles."""
    fan = int(np.clip(HELD // max(largest, 1), 2, 64))
    while tasks > 1:
        lanes = parts.withColumn("lane", (F.col("lane") / fan).cast("int"))
        parts = lanes.groupBy("key", "lane").applyInArrow(_added, SCHEMA)
        tasks = -(-tasks // fan)
    return {r["key"]: np.array(r["parts"]) for r in parts.select("key", "parts").toArrow().to_pylist()}
