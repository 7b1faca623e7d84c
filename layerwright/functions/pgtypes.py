"""Typed parsing of PostgreSQL text values by type id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# PostgreSQL type ids and the Spark type of each.
PG_TYPES = {
    16: "boolean",  # boolean
    17: "binary",  # bytea
    18: "string",  # char
    19: "string",  # name
    20: "bigint",  # int8
    21: "smallint",  # int2
    23: "int",  # int4
    25: "string",  # text
    114: "string",  # json
    142: "string",  # xml
    600: "string",  # point
    601: "string",  # lseg
    602: "string",  # path
    603: "string",  # box
    604: "string",  # polygon
    628: "string",  # line
    650: "string",  # cidr
    700: "float",  # float4
    701: "double",  # float8
    718: "string",  # circle
    790: "decimal(19,2)",  # money
    829: "string",  # macaddr
    869: "string",  # inet
    1042: "string",  # bpchar
    1043: "string",  # varchar
    1082: "date",  # date
    1083: "string",  # time
    1114: "timestamp_ntz",  # timestamp
    1184: "timestamp",  # timestamptz
    1186: "string",  # interval
    1266: "string",  # timetz
    1560: "string",  # bit
    1562: "string",  # varbit
    1700: "double",  # numeric
    1790: "string",  # refcursor
    2202: "bigint",  # regprocedure
    2203: "bigint",  # regoper
    2204: "bigint",  # regoperator
    2205: "bigint",  # regclass
    2206: "bigint",  # regtype
    2950: "string",  # uuid
    3802: "string",  # jsonb
    3904: "string",  # int4range
    3906: "string",  # numrange
    3908: "string",  # tsrange
    3910: "string",  # tstzrange
    3912: "string",  # daterange
    3926: "string",  # int8range
}


def numeric_type(modifier: int) -> str:
    """Decimal type of a ``numeric`` column from its type modifier; double without one."""
    if modifier < 4:
        return "double"
    precision, scale = (modifier - 4) >> 16, (modifier - 4) & 0xFFFF
    return f"decimal({precision},{scale})" if precision <= 38 else "double"


def spark_type(type_id: int, modifier: int = -1, parity: bool = False) -> str:
    """Spark type for a type id. ``parity`` keeps ``numeric`` as a double whatever its modifier."""
    if type_id not in PG_TYPES:
        raise ValueError(f"no Spark type for PostgreSQL type id {type_id}")
    if type_id == 1700 and not parity:
        return numeric_type(modifier)
    return PG_TYPES[type_id]


def parse_value(text: Column, type_id: int, modifier: int = -1, parity: bool = False) -> Column:
    """A text value in its Spark type; NULL when it does not parse."""
    target = spark_type(type_id, modifier, parity)
    if target == "binary":
        return F.unhex(F.regexp_replace(text, r"^\\x", ""))
    if type_id == 790:
        return F.regexp_replace(text, r"[^0-9.\-]", "").try_cast(target)
    return text if target == "string" else text.try_cast(target)
