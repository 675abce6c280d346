"""Overlapping and gapped intervals: continuous spans and the holes between them.

Two levels, so that one huge entity is no single task. An entity's axis is cut into
shards of fixed width; intervals are clipped into the shards of their two ends, whole
shards between are counted by +1/-1 deltas; pieces merge locally per (entity, shard);
only pieces at a shard boundary (at most two per shard) are stitched. As rows with
the same start are aggregated first, a shard never holds more rows than its width.

Bounds are whole numbers, both ends included; neighbouring numbers touch. Defined
results: a null bound or an end before its start is no interval; repeated rows change
nothing; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.session import cut

WIDTH = 65_536


def merge_intervals(df: DataFrame, keys: list[str], low: str, high: str, width: int = WIDTH) -> DataFrame:
    """Maximal continuous spans per entity: keys, ``low``, ``high``."""
    clean = df.select(*keys, F.col(low).cast("long").alias("lo"), F.col(high).cast("long").alias("hi")).where("lo <= hi")
    clean = clean.groupBy(*keys, "lo").agg(F.max("hi").alias("hi"))
    clean = clean.withColumn("s1", F.expr(f"cast(floor(lo / {width}) as bigint)")).withColumn("s2", F.expr(f"cast(floor(hi / {width}) as bigint)"))
    # kind 0: a piece inside one shard. kind 1: a change of the number of intervals that cover whole shards.
    cells = clean.select(*keys, F.explode(F.expr(f"""
        case when s1 = s2 then array(named_struct('sh', s1, 'lo', lo, 'hi', hi, 'd', 0))
             when s2 = s1 + 1 then array(named_struct('sh', s1, 'lo', lo, 'hi', s2 * {width} - 1, 'd', 0),
                                         named_struct('sh', s2, 'lo', s2 * {width}, 'hi', hi, 'd', 0))
             else array(named_struct('sh', s1, 'lo', lo, 'hi', (s1 + 1) * {width} - 1, 'd', 0),
                        named_struct('sh', s2, 'lo', s2 * {width}, 'hi', hi, 'd', 0),
                        named_struct('sh', s1 + 1, 'lo', (s1 + 1) * {width}, 'hi', cast(null as bigint), 'd', 1),
                        named_struct('sh', s2, 'lo', s2 * {width}, 'hi', cast(null as bigint), 'd', -1)) end""")).alias("p")).select(*keys, "p.*")  # fmt: skip
    cells = cut(cells.groupBy(*keys, "sh", "lo").agg(F.max("hi").alias("hi"), F.sum("d").alias("d")))

    inside = Window.partitionBy(*keys, "sh").orderBy("lo")
    reach = F.max("hi").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    pieces = cells.where("hi is not null").withColumn("fresh", F.coalesce((F.col("lo") > reach + 1).cast("int"), F.lit(1)))
    pieces = pieces.withColumn("isle", F.sum("fresh").over(inside))
    local = pieces.groupBy(*keys, "sh", "isle").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("isle")

    # Running number of intervals that cover a shard whole, at every shard with a piece or a change.
    run = Window.partitionBy(*keys).orderBy("sh")
    shards = cells.groupBy(*keys, "sh").agg(F.sum("d").alias("d")).withColumn("c", F.sum("d").over(run))
    changes = shards.where("d <> 0").select(*keys, "sh", "c", F.lead("sh").over(run).alias("nx")).where("c > 0")
    whole = changes.select(*keys, "sh", F.expr(f"sh * {width}").alias("lo"), F.expr(f"nx * {width} - 1").alias("hi"))
    # Pieces inside a covered shard add nothing.
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*keys, "sh")]
    local = local.alias("l").join(shards.where("c > 0").select(*keys, "sh").alias("r"), same, "left_anti")

    along = Window.partitionBy(*keys).orderBy("lo")
    at_edge = f"pmod(lo, {width}) = 0 or pmod(hi, {width}) = {width - 1}"
    touch = local.where(at_edge).unionByName(whole)
    before = F.max("hi").over(along.rowsBetween(Window.unboundedPreceding, -1))
    touch = touch.withColumn("fresh", F.coalesce((F.col("lo") > before + 1).cast("int"), F.lit(1))).withColumn("isle", F.sum("fresh").over(along))
    stitched = touch.groupBy(*keys, "isle").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    spans = local.where(f"not ({at_edge})").select(*keys, "lo", "hi").unionByName(stitched.select(*keys, "lo", "hi"))
    if_covered = spans.select(*keys, F.col("lo").alias(low), F.col("hi").alias(high))
    return cut(if_covered)


def next_start(df: DataFrame, keys: list[str], at: str, out: str, width: int = WIDTH) -> DataFrame:
    """All rows with the next higher ``at`` of their entity as ``out`` (null at the last). Rows must be distinct in (keys, ``at``)."""
    d = df.withColumn("__sh", F.expr(f"cast(floor({at} / {width}) as bigint)"))
    firsts = d.groupBy(*keys, "__sh").agg(F.min(at).alias("__first"))
    firsts = firsts.select(*keys, "__sh", F.lead("__first").over(Window.partitionBy(*keys).orderBy("__sh")).alias("__later"))
    near = F.lead(at).over(Window.partitionBy(*keys, "__sh").orderBy(at))
    return d.withColumn("__near", near).join(firsts, [*keys, "__sh"]).withColumn(out, F.coalesce("__near", "__later")).drop("__sh", "__near", "__later")


def gaps_between(spans: DataFrame, keys: list[str], low: str, high: str, width: int = WIDTH) -> DataFrame:
    """The holes between consecutive spans of an entity (disjoint spans in, as :func:`merge_intervals` gives)."""
    following = next_start(spans, keys, low, "__next", width).where("__next is not null")
    return following.select(*keys, (F.col(high) + 1).alias(low), (F.col("__next") - 1).alias(high))
