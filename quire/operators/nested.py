"""Nested, shape-varying records to flat child tables with parent links.

Two steps. The JVM brings every spelling of "zero or more things" (array, single
object, object keyed by index, JSON text inside a JSON string, null) to one shape,
``array<struct<pos, v>>``. Then Arrow list kernels (offsets, parent indices and a
vectorised take of the keys) turn a level of lists into child rows without looking
at single records.

Defined results: a null, missing or empty list yields no child row; null entries
and entries without any field keep their place but yield no child row; a broken
JSON text yields nothing; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_level(batch: pa.RecordBatch, column: str, position: str, value: str) -> pa.RecordBatch:
    """One list column becomes child rows; all other columns follow by ``take``.

    ``position`` is the 0-based place in the list, ``value`` the entry.
    """
    lists = batch.column(column)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    parents = pc.list_parent_indices(lists)
    entries = pc.list_flatten(lists)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    at = parents.to_numpy(zero_copy_only=False)
    places = np.arange(len(entries), dtype=np.int64) - starts[at]
    names, arrays = [], []
    for name in batch.schema.names:
        if name != column:
            names.append(name)
            arrays.append(pc.take(batch.column(name), parents))
    return pa.RecordBatch.from_arrays([*arrays, pa.array(places), entries], names=[*names, position, value])


def _has_field(entries: pa.Array) -> pa.Array:
    """True where an entry exists and, for structs, has at least one non-null field."""
    there = pc.is_valid(entries)
    if pa.types.is_struct(entries.type):
        some = pa.array(np.zeros(len(entries), dtype=bool))
        for child in entries.flatten():  # flatten() puts the struct's own nulls into its children
            some = pc.or_(some, pc.is_valid(child))
        there = pc.and_(there, some)
    return there


def explode_arrow(df: DataFrame, column: str, positions: list[str], value: str) -> DataFrame:
    """Flatten ``len(positions)`` nested list levels of ``column`` at once.

    The result has the other columns of ``df``, one bigint position column per level
    and the innermost entry as ``value``; absent entries (null, or a struct of nulls)
    are dropped after their place is counted. Narrow: no shuffle, one pass per batch.
    """
    kept = [f for f in df.schema.fields if f.name != column]
    kind = df.schema[column].dataType
    for _ in positions:
        if not isinstance(kind, T.ArrayType):
            raise TypeError(f"{column} has fewer than {len(positions)} list levels")
        kind = kind.elementType
    schema = T.StructType([*kept, *[T.StructField(p, T.LongType()) for p in positions], T.StructField(value, kind)])
    order = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inner = column
            for k, place in enumerate(positions):
                out = value if k == len(positions) - 1 else f"__level_{k}"
                batch = flatten_level(batch, inner, place, out)
                inner = out
            keep = _has_field(batch.column(value))
            batch = batch.filter(keep)
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in order], names=order)

    return df.mapInArrow(run, schema)


def entries_of(v: str) -> Column:
    """SQL over a variant expression: its things as ``array<struct<pos bigint, v variant>>``.

    Array: every entry at its place. Object keyed by 0, 1, ...: its values at these
    places. Any other object, or plain text: one thing at place 0. JSON inside a text
    counts as that JSON. A number or boolean is a count, not a thing. Null: nothing.
    """
    return F.expr(entries_sql(v))


def entries_sql(v: str) -> str:
    u = f"(case when schema_of_variant({v}) = 'STRING' then coalesce(try_parse_json(try_variant_get({v}, '$', 'string')), {v}) else {v} end)"
    kind = f"schema_of_variant({u})"
    as_map = f"try_variant_get({u}, '$', 'map<string,variant>')"
    return f"""(case
      when {v} is null then cast(null as array<struct<pos:bigint,v:variant>>)
      when {kind} like 'ARRAY%' then transform(try_variant_get({u}, '$', 'array<variant>'), (x, i) -> struct(cast(i as bigint) as pos, x as v))
      when {kind} like 'OBJECT<%' and size({as_map}) > 0 and forall(map_keys({as_map}), k -> k rlike '^[0-9]{{1,9}}$')
        then transform(map_entries({as_map}), e -> struct(cast(e.key as bigint) as pos, e.value as v))
      when {kind} like 'OBJECT<%' then array(struct(0L as pos, {u} as v))
      when {kind} = 'STRING' and trim(try_variant_get({u}, '$', 'string')) <> '' then array(struct(0L as pos, {u} as v))
      else cast(array() as array<struct<pos:bigint,v:variant>>) end)"""


def has_fields_sql(v: str) -> str:
    """Whether a variant is a thing with content: not null, not an object without any value."""
    return f"""({v} is not null and schema_of_variant({v}) <> 'VOID' and not (schema_of_variant({v}) like 'OBJECT<%'
      and forall(map_values(try_variant_get({v}, '$', 'map<string,variant>')), x -> x is null or schema_of_variant(x) = 'VOID')))"""


def unwrap_json(df: DataFrame, text: str, out: str) -> DataFrame:
    """Parse a JSON text column to a variant; text that holds JSON text is parsed again; broken text gives null."""
    v = F.expr(f"try_parse_json({text})")
    df = df.withColumn(out, v)
    return df.withColumn(
        out,
        F.expr(f"case when schema_of_variant({out}) = 'STRING' then try_parse_json(try_variant_get({out}, '$', 'string')) else {out} end"),
    )


def explode_shaped(df: DataFrame, variant: str, key: str, pos: str, value: str) -> DataFrame:
    """One level of a shape-varying variant column to rows (key, pos, value as JSON text), by :func:`explode_arrow`."""
    shaped = df.select(key, F.expr(f"transform({entries_sql(variant)}, e -> named_struct('pos', e.pos, 'v', case when {has_fields_sql('e.v')} then to_json(e.v) end))").alias("__things"))
    flat = explode_arrow(shaped, "__things", ["__place"], "__thing")
    return flat.select(key, F.col("__thing.pos").alias(pos), F.col("__thing.v").alias(value)).where(F.col(value).isNotNull())
