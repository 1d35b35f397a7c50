"""Nested texts as JSON while their rows are shuffled and sorted."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

# Longer JSON texts stay nested: JSON readers limit the length of a text.
LONGEST = 1_000_000

Step = Callable[[DataFrame], DataFrame]


class Compact(NamedTuple):
    """What a result of ``compactly`` was made of."""

    rows: DataFrame
    back: Step
    same: set[str]  # columns that are the same in both


def compactly(df: DataFrame, move: Step, reads: Iterable[str], finish: Step | None = None, same: Iterable[str] = ()) -> DataFrame:
    """``finish(move(df))``, with arrays and structs of texts carried as JSON through ``move``.

    In a row every text of an array has 8 bytes of place and size, is filled up to 8 bytes, and has a
    struct of 16 bytes more around it; compression leaves much of that. As JSON a record takes
    about half of the shuffled and spilled bytes. ``move`` places, orders or drops rows by the columns
    it ``reads``, none of them nested. Bytes that are not UTF-8 would turn into U+FFFD, so values
    with that character stay nested.

    ``finish`` makes the final columns row by row and leaves ``same`` as they are. A result that is
    moved once more by such columns is moved as it was before the JSON was read, and finished
    only then: a range shuffle computes its input twice, for its bounds and for its rows. One
    that is cached is taken from there.
    """
    made = None if df.is_cached else getattr(df, "_compact", None)
    packed = made if made and made.same.issuperset(reads) else _packed(df)
    rows = move(packed.rows)
    back = (lambda x: finish(packed.back(x))) if finish else packed.back
    done = back(rows)
    done._compact = Compact(rows, back, packed.same & set(same) if finish else packed.same)
    return done


def _packed(df: DataFrame) -> Compact:
    nested = {f.name: f.dataType for f in df.schema.fields if not isinstance(f.dataType, StringType) and _of_texts(f.dataType)}
    rows = df.select("*", *[F.to_json(_at(x)).alias(_json(x)) for x in nested])
    fits = {x: (F.octet_length(_at(_json(x))) <= LONGEST) & ~F.contains(_at(_json(x)), F.lit("\ufffd")) for x in nested}
    rows = rows.select(
        *[F.when(~fits[x], _at(x)).alias(x) if x in nested else _at(x) for x in df.columns],
        *[F.when(fits[x], _at(_json(x))).alias(_json(x)) for x in nested],
    )

    def back(rows: DataFrame) -> DataFrame:
        read = {x: F.coalesce(F.from_json(_at(_json(x)), type_), _at(x)) for x, type_ in nested.items()}
        kept = [x for x in rows.columns if x not in {*map(_json, nested)}]
        return rows.select(*[read[x].alias(x) if x in read else _at(x) for x in kept])

    return Compact(rows, back, set(df.columns) - set(nested))


def _at(name: str) -> Column:
    return F.col(f"`{name}`")


def _json(name: str) -> str:
    return f"_json_{name}"


def _of_texts(type_: DataType) -> bool:
    if isinstance(type_, ArrayType):
        return _of_texts(type_.elementType)
    if isinstance(type_, StructType):
        return bool(type_.fields) and all(_of_texts(f.dataType) for f in type_.fields)
    return isinstance(type_, StringType)
