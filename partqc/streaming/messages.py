"""JSON messages: build, parse and flatten (P3-P7, S5 frame).

Parsing follows ``from_json`` with double fields: numbers parse, a quoted
number gives null for that field, ``NaN`` gives NaN, a missing field is
null, text that is not a JSON object gives a struct of nulls, and an empty
or null message gives a null struct (all fields null after flattening).
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CYCLE_TIME


def to_messages(df: DataFrame, fields: Sequence[str | Column], value_col: str = "value",
                as_binary: bool = True) -> DataFrame:
    """One JSON object per row from the given columns, in a ``value`` column
    (binary, as a Kafka record carries it). Null fields are left out."""
    js = F.to_json(F.struct(*fields))
    return df.select((js.cast("binary") if as_binary else js).alias(value_col))


def parse_messages(df: DataFrame, schema: T.StructType, value_col: str = "value",
                   out_col: str = "value") -> DataFrame:
    """P4 + P6: binary/text value -> struct with the fixed schema."""
    return df.select(F.from_json(F.col(value_col).cast("string"), schema).alias(out_col))


def flatten(df: DataFrame, struct_col: str = "value") -> DataFrame:
    """One column per struct field."""
    return df.select(f"{struct_col}.*")


def parse_flatten(df: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """P3 + P4: what the scoring stream does to every message."""
    return flatten(parse_messages(df, schema, value_col, "_msg"), "_msg")


def parse_flatten_counted(df: DataFrame, schema: T.StructType, name: str = "messages",
                          required: Sequence[str] | None = None, value_col: str = "value") -> DataFrame:
    """:func:`parse_flatten` with counters, on a batch or a stream: of
    ``messages``, the ``malformed`` (empty, or text that is no JSON object with
    any of the fields) and the ``incomplete`` (a ``required`` field, all by
    default, null or NaN) are lost to scoring. The counters ride along in the
    same pass (``Dataset.observe``) and come with each batch's progress."""
    flat = parse_flatten(df, schema, value_col)
    kinds = {f.name: f.dataType for f in schema.fields}
    required = list(kinds) if required is None else list(required)
    missing = lambda c: (F.col(c).isNull() | F.isnan(c)) if isinstance(kinds[c], (T.DoubleType, T.FloatType)) else F.col(c).isNull()
    nothing = functools.reduce(lambda a, b: a & b, [F.col(c).isNull() for c in kinds])
    lacking = functools.reduce(lambda a, b: a | b, [missing(c) for c in required], F.lit(False))
    return flat.observe(name, F.count(F.lit(1)).alias("messages"), F.count_if(nothing).alias("malformed"),
                        F.count_if(lacking & ~nothing).alias("incomplete"))


def alert_frame(scored: DataFrame, key_col: str = CYCLE_TIME, prediction: str = "prediction") -> DataFrame:
    """``key`` = cycle time as text, ``value`` = JSON of the cycle
    time (as a JSON string) and the prediction; null fields are left out."""
    slim = scored.select(F.col(key_col).cast("string").alias(key_col), F.col(prediction))
    return slim.select(F.col(key_col).alias("key"), F.to_json(F.struct(key_col, prediction)).alias("value"))
