"""Filling containers of one capacity by minimum bin slack, planned on a length histogram.

Items of equal length are interchangeable, so the plan needs only how many items each
length has: at most ``capacity`` rows, whatever the corpus. Per container the largest
remaining length is taken and a bitset subset-sum over the remaining lengths (with
multiplicity) finds the fullest feasible combination, which is then removed as often
as the counts allow. Items find their container by their rank within their length.

Defined results: an item longer than the capacity is divided into full pieces and a
rest, no other item is; items of size 0 (null or empty text) take no room and are
spread over all containers; with no item of positive size they share container 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import cut

CAPACITY = 2048
#: Items per (length, bucket) that one ranking task sorts, about.
RANK_ROWS = 1_000_000


@dataclass
class Plan:
    """Arrays sorted by (length, start): items of ``length`` with ranks from ``start`` on go, ``use`` per container, to containers from ``base`` on."""

    length: np.ndarray
    start: np.ndarray
    use: np.ndarray
    base: np.ndarray
    containers: int


def fullest(room: int, counts: dict[int, int]) -> dict[int, int]:
    """The combination of available lengths with the largest sum up to ``room``; larger lengths are tried first."""
    steps: list[tuple[int, int]] = []
    seen = [1]
    reach, mask = 1, (1 << (room + 1)) - 1
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, block = min(counts[length], room // length), 1
        while left:
            take = min(block, left)
            left -= take
            block *= 2
            grown = (reach | (reach << (take * length))) & mask
            if grown != reach:
                reach = grown
                steps.append((length, take))
                seen.append(reach)
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for k in range(len(steps) - 1, -1, -1):
        length, take = steps[k]
        if not seen[k] >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= take * length
    return used


def plan_bins(histogram: dict[int, int], capacity: int) -> Plan:
    """Minimum-bin-slack plan for a histogram of lengths 1..capacity."""
    counts = {x: n for x, n in histogram.items() if n}
    done = dict.fromkeys(counts, 0)
    rows, containers = [], 0
    while counts:
        largest = max(counts)
        counts[largest] -= 1
        use = fullest(capacity - largest, counts)
        counts[largest] += 1
        use[largest] = use.get(largest, 0) + 1
        times = min(counts[x] // k for x, k in use.items())
        for x, k in use.items():
            rows.append((x, done[x], k, containers))
            done[x] += k * times
            counts[x] -= k * times
            if not counts[x]:
                del counts[x]
        containers += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return Plan(table[:, 0], table[:, 1], table[:, 2], table[:, 3], containers)


def pieces_of(sizes: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """Items: (key, piece, size); only items above the capacity have more than one piece."""
    parts = F.expr(f"transform(sequence(0, greatest(cast(ceil({size} / {capacity}) as int), 1) - 1), i -> named_struct('piece', i, 'size', least({size} - i * {capacity}, {capacity})))")
    return sizes.select(key, F.explode(parts).alias("p")).select(key, "p.piece", F.col("p.size").cast("int").alias("size"))


def pack(sizes: DataFrame, key: str, size: str, capacity: int = CAPACITY, rank_rows: int = RANK_ROWS) -> DataFrame:
    """``key``, ``piece``, ``size`` and the ``container`` of every item. ``key`` must be unique and not null.

    Shuffles only (key, piece, size): once to rank the items of a length within hashed
    buckets, as one length may hold a large share of all rows.
    """
    items = cut(pieces_of(sizes, key, size, capacity))
    histogram = {r["size"]: r["n"] for r in items.groupBy("size").agg(F.count("*").alias("n")).collect()}  # at most capacity + 1 rows
    total = sum(histogram.values())
    histogram.pop(0, None)
    plan = plan_bins(histogram, capacity)
    buckets = max(16, total // rank_rows)
    items = items.withColumn("__b", F.pmod(F.xxhash64(key, "piece"), F.lit(buckets)))
    per = items.groupBy("size", "__b").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("size").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("size", "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    ranked = items.withColumn("__r", F.row_number().over(Window.partitionBy("size", "__b").orderBy(key, "piece")) - 1)
    ranked = ranked.join(per, ["size", "__b"]).select(key, "piece", "size", (F.col("__base") + F.col("__r")).cast("long").alias("__rank"))
    schema = T.StructType([*[ranked.schema[c] for c in (key, "piece", "size")], T.StructField("container", T.LongType(), False)])
    spread = max(plan.containers, 1)
    scale = np.int64(1) << 40  # ranks within a length stay below this

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = plan.length * scale + plan.start
        for batch in batches:
            length = batch.column("size").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("__rank").to_numpy(zero_copy_only=False).astype(np.int64)
            if len(order):
                row = np.maximum(np.searchsorted(order, length * scale + rank, side="right") - 1, 0)
                container = plan.base[row] + (rank - plan.start[row]) // plan.use[row]
            else:
                container = np.zeros_like(rank)
            container = np.where(length == 0, rank % spread, container)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (key, "piece", "size")], pa.array(container)], names=[key, "piece", "size", "container"])

    return ranked.mapInArrow(place, schema)
