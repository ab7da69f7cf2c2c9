"""A number for the rows of a table that does not depend on their order or engine.

The text of a row is that of its columns by name: each value as ``=`` and its text, a
NULL as ``~``, with a unit separator between. Fractions count in millionths, rounded, as
engines write them differently. The first 60 bits of the MD5 of that text are the row's
number, and the sum of these modulo 10^18 the table's: equal rows count as often as they
are there, and a row that is missing, doubled or changed shows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODULUS = 10**18
_FRACTIONS = (T.FloatType, T.DoubleType, T.DecimalType)


def _text(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _FRACTIONS):
        value = F.floor(value.cast("double") * 1_000_000 + 0.5)
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("~"))


def row_number(df: DataFrame) -> Column:
    """The number of a row, a decimal without fraction."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    text = F.concat_ws("\x1f", *map(_text, fields))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(20,0)")


def checksum(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` and ``checksum`` of a table; an empty one has zero for both."""
    total = F.coalesce(F.sum(row_number(df)), F.lit(0)) % MODULUS
    return df.agg(F.count(F.lit(1)).alias("n_rows"), total.cast("long").alias("checksum"))


def checksum_sql(relation: str, columns: list[str], fractions: tuple[str, ...] = ()) -> str:
    """The same in SQL with ``md5`` and hexadecimal casts, over a parenthesised query."""

    def text(name: str) -> str:
        value = f'"{name}"'
        if name in fractions:
            value = f"cast(floor({value}*1000000+0.5) as bigint)"
        return f"coalesce('='||cast({value} as varchar),'~')"

    joined = "||chr(31)||".join(map(text, sorted(columns)))
    number = f"cast('0x'||left(md5({joined}),15) as bigint)"
    return (
        f"select count(*) as n_rows, cast(coalesce(sum({number}),0)%{MODULUS} as bigint)"
        f" as checksum from ({relation}) q"
    )
