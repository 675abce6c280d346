"""References to records that are missing, deleted or arrive later.

Existence and references are kept as signed change deltas per key: an arriving record
is +1 at its time, a deletion -1, a reference +1 on the reference side. A key whose
reference count is positive while its existence count is zero is an orphan. Running
counts are two-level prefix sums (per key and day, then inside the day), so a hot key
is split by time and pre-aggregated before each shuffle; no key is ever gathered whole.

The counts can be kept in a table: :func:`advance` takes the state of all changes so far
and one batch of later ones, and gives the orphans of the batch and the next state;
:func:`current_orphans` reads the report from the state alone. History is not read again.

Defined results: null and blank references refer to nothing; a record deleted at or
before its arrival never existed; repeated rows change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Spaces that trimming must see besides the ASCII ones.
BLANKS = "[\\s\\u00A0\\u2000-\\u200D\\u202F\\u205F\\u2060\\u3000\\uFEFF]+"


def section_key(c: Column) -> Column:
    """The section that a text names: its first whole number without leading zeros, or else the bare name in lower case; null for blank text."""
    flat = F.trim(F.regexp_replace(F.lower(F.translate(c, "０１２３４５６７８９", "0123456789")), BLANKS, " "))
    number = F.regexp_extract(flat, "([0-9]+)", 1)
    return F.when(number != "", F.regexp_replace(number, "^0+(?=[0-9])", "")).when(flat != "", flat)


def running_existence(events: DataFrame, keys: list[str], at: str, delta: str, refs: str, state: DataFrame | None = None) -> DataFrame:
    """Existence count of each key at each of its reference times.

    ``events``: keys, ``at`` timestamp, ``delta`` change of existence, ``refs`` number of
    references. Changes at a time count before references at that time. ``state``: keys and
    their count ``alive`` before all events. Result: keys, ``at``, ``refs``, ``alive`` for
    every time with references.
    """
    per_time = events.groupBy(*keys, at).agg(F.sum(delta).alias("__d"), F.sum(refs).alias(refs))
    per_time = per_time.withColumn("__day", F.to_date(at))
    day_sum = per_time.groupBy(*keys, "__day").agg(F.sum("__d").alias("__day_d"))
    before = Window.partitionBy(*keys).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    day_sum = day_sum.select(*keys, "__day", F.coalesce(F.sum("__day_d").over(before), F.lit(0)).alias("__base"))
    within = Window.partitionBy(*keys, "__day").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    inside = per_time.withColumn("__in", F.sum("__d").over(within)).where(F.col(refs) > 0)
    counted = inside.join(day_sum, [*keys, "__day"]).select(*keys, at, refs, (F.col("__base") + F.col("__in")).alias("alive"))
    if state is None:
        return counted
    before = counted.join(state.select(*keys, F.col("alive").alias("__before")), keys, "left")
    return before.withColumn("alive", F.col("alive") + F.coalesce("__before", F.lit(0))).drop("__before")


def change_events(records: DataFrame, references: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ``at``, ``delta``, ``refs``: arrivals (+1) and deletions (-1) of records, and references (+1 each).

    ``records``: keys, ``loaded_at``, ``deleted_at``. ``references``: keys, ``loaded_at``. A record gone at or before its arrival is no change.
    """
    live = records.where(F.col("deleted_at").isNull() | (F.col("deleted_at") > F.col("loaded_at"))).dropna(subset=[*keys, "loaded_at"])
    change = lambda df, at, delta, refs: df.select(*keys, F.col(at).alias("at"), F.lit(delta).alias("delta"), F.lit(refs).alias("refs"))
    asked = references.dropna(subset=[*keys, "loaded_at"])
    return change(live, "loaded_at", 1, 0).unionByName(change(live.where(F.col("deleted_at").isNotNull()), "deleted_at", -1, 0)).unionByName(change(asked, "loaded_at", 0, 1))


def no_counts(events: DataFrame, keys: list[str]) -> DataFrame:
    """The state before any change."""
    return events.limit(0).select(*keys, F.lit(0).cast("long").alias("alive"), F.lit(0).cast("long").alias("refs"))


def advance(state: DataFrame, batch: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(orphans of the batch: keys, ``loaded_at``, ``refs``; the next state: keys, ``alive``, ``refs``).

    ``batch``: change events later than all of the state. The state holds one row a key; only keys of the batch change,
    and a key without any count left goes. Batches may be empty and repeat keys.
    """
    asked = running_existence(batch, keys, "at", "delta", "refs", state)
    orphans_ = asked.where(F.col("alive") <= 0).select(*keys, F.col("at").alias("loaded_at"), "refs")
    change = batch.groupBy(*keys).agg(F.sum("delta").alias("alive"), F.sum("refs").alias("refs"))
    merged = state.select(*keys, "alive", "refs").unionByName(change).groupBy(*keys).agg(F.sum("alive").alias("alive"), F.sum("refs").alias("refs"))
    return orphans_, merged.where("alive <> 0 or refs <> 0")


def current_orphans(state: DataFrame) -> DataFrame:
    """Keys with references and no existing record, by the state."""
    return state.where((F.col("refs") > 0) & (F.col("alive") <= 0))


def orphan_times(records: DataFrame, references: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and times with references but no existing record.

    ``records``: keys, ``loaded_at``, ``deleted_at``. ``references``: keys, ``loaded_at``.
    """
    counted = running_existence(change_events(records, references, keys), keys, "at", "delta", "refs")
    return counted.where(F.col("alive") <= 0).select(*keys, F.col("at").alias("loaded_at"), "refs")


def orphan_references(records: DataFrame, references: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``references`` whose key has no record at their ``loaded_at``."""
    dead = orphan_times(records, references, keys).select(*keys, "loaded_at")
    return references.join(dead, [*keys, "loaded_at"], "left_semi")
