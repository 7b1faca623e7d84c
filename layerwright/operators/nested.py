"""Nested data: JSON arrays to rows, structs to columns, nested cells to JSON text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct_of(fields: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in fields])


def json_array(col: Column, fields: Iterable[str]) -> Column:
    """A JSON array as array of structs with every field as text; NULL if any of it does not parse."""
    return F.from_json(col, T.ArrayType(_struct_of(fields)))


#: The pieces of a JSON text: strings, also one that is cut off, marks, and what is between them.
_PIECES = r'"(?:[^"\\]|\\.)*+"?|[\[\]{},]|[^"\[\]{},]++'


def split_elements(col: Column) -> Column:
    """The elements of a JSON array as texts, told apart by depth alone, so that a broken one leaves the others whole.

    What stands before the array and behind it belongs to no element; a cut-off array ends with what there is. A text that is no
    array is one element.
    """
    def text(value: str | Column) -> Column:
        return F.lit(value) if isinstance(value, str) else value

    def state(depth: Column, held: Column | str, done: Column) -> Column:
        return F.struct(depth.alias("depth"), text(held).alias("held"), done.alias("done"))

    def ended(held: Column, done: Column) -> Column:
        element = F.trim(held)
        return F.when(element != "", F.concat(done, F.array(element))).otherwise(done)

    def step(now: Column, piece: Column) -> Column:
        depth, held, done = now["depth"], now["held"], now["done"]
        opens, closes = piece.isin("[", "{"), piece.isin("]", "}")
        longer = F.concat(held, piece)
        return (
            F.when(opens & (depth == 0), state(F.lit(1), "", done))
            .when(opens, state(depth + 1, longer, done))
            .when(closes & (depth == 1), state(F.lit(0), "", ended(held, done)))
            .when(closes & (depth > 1), state(depth - 1, longer, done))
            .when((piece == ",") & (depth == 1), state(depth, "", ended(held, done)))
            .when(depth > 0, state(depth, longer, done))
            .otherwise(now)
        )

    start = state(F.lit(0), "", F.array().cast("array<string>"))
    elements = F.aggregate(F.regexp_extract_all(col, F.lit(_PIECES), F.lit(0)), start, step, lambda now: ended(now["held"], now["done"]))
    whole = F.trim(col)
    return F.when(F.startswith(whole, F.lit("[")), elements).when(whole != "", F.array(whole)).when(col.isNotNull(), F.array().cast("array<string>"))


def _good(element: Column) -> Column:
    """Whether an element is a JSON object."""
    return F.startswith(element, F.lit("{")) & F.try_parse_json(element).isNotNull()


def unnest_json_array(df: DataFrame, col: str, fields: Mapping[str, str], alias: str = "item") -> DataFrame:
    """One row per element; a row whose array is missing or empty is kept with a NULL element.

    An array that does not parse as a whole, as it is cut off or one element is broken or no object, is read element by element: the good
    ones give their rows, and :func:`json_rejects` has the others. Fields are read as text and cast leniently after the rows are unfolded, so
    that fields nobody uses are not parsed and casts run in generated code.
    """
    rest = [c for c in df.columns if c != col]
    one = _struct_of(fields)
    singly = F.transform(F.filter(split_elements(F.col(col)), _good), lambda e: F.from_json(e, one))
    rows = df.select(*rest, F.explode_outer(F.coalesce(json_array(F.col(col), fields), singly)).alias("_text"))
    typed = F.struct(*[
        (F.col(f"_text.{name}") if kind == "string" else F.col(f"_text.{name}").try_cast(kind)).alias(name)
        for name, kind in fields.items()
    ])
    return rows.select(*rest, typed.alias(alias))


def json_rejects(df: DataFrame, col: str) -> DataFrame:
    """The elements that :func:`unnest_json_array` leaves out: the other columns, the element's place in its array from 1, and its text."""
    rest = [c for c in df.columns if c != col]
    broken = df.where(F.col(col).isNotNull() & json_array(F.col(col), ["_"]).isNull())
    elements = broken.select(*rest, F.posexplode(split_elements(F.col(col))).alias("_at", "_element"))
    return elements.where(~_good(F.col("_element"))).select(*rest, (F.col("_at") + 1).alias("place"), F.col("_element").alias("element"))


def _leaves(schema: T.StructType, prefix: str = "") -> list[tuple[str, Column]]:
    out = []
    for field in schema.fields:
        path = f"{prefix}.{field.name}" if prefix else field.name
        if isinstance(field.dataType, T.StructType):
            out.extend(_leaves(field.dataType, path))
        else:
            out.append((path, F.col(".".join(f"`{p}`" for p in path.split(".")))))
    return out


def flatten_structs(df: DataFrame) -> DataFrame:
    """Every nested field as a column named by its dotted path."""
    return df.select(*[col.alias(path) for path, col in _leaves(df.schema)])


def paths_of_key(schema: T.StructType, key: str) -> list[str]:
    """Where a key can be found: a struct's own level first, else its nested structs in order, never arrays."""
    if key in schema.fieldNames():
        return [key]
    return [
        f"{field.name}.{below}" for field in schema.fields if isinstance(field.dataType, T.StructType)
        for below in paths_of_key(field.dataType, key)
    ]


def value_of_key(df: DataFrame, key: str) -> Column:
    """The first value under a key at any depth; a NULL when the schema has no such key.

    A nested place without a value gives way to the next place of the same type.
    """
    paths = paths_of_key(df.schema, key)
    if not paths:
        return F.lit(None).cast("string")
    kinds = df.select(*[F.col(p).alias(f"c{i}") for i, p in enumerate(paths)]).schema
    same = [p for p, f in zip(paths, kinds.fields) if f.dataType == kinds.fields[0].dataType]
    return F.coalesce(*[F.col(p) for p in same])


def nested_to_json(df: DataFrame) -> DataFrame:
    """Struct, array and map columns as JSON text; characters beyond ASCII are kept."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[
        F.to_json(F.col(f"`{f.name}`"), {"ignoreNullFields": "false"}).alias(f.name)
        if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
