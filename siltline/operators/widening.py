"""Columns whose type grows: the narrowest type that holds every value of two without loss.

Parquet files written with the narrower type are read as the wider one, so a table widens without a rewrite.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
)

from siltline.functions import columns as fx

MAX_DIGITS = 38
CHAINS = ([ByteType(), ShortType(), IntegerType(), LongType()], [FloatType(), DoubleType()])


def wider(a: DataType, b: DataType) -> DataType | None:
    """The narrowest type for values of both; None if there is none that the library widens to.

    Whole numbers widen among themselves, as do the two floating types; decimals keep all digits on both sides of the
    point, 38 at most. Anything else, such as numbers and text, has no common type.
    """
    if a == b:
        return a
    for chain in CHAINS:
        if a in chain and b in chain:
            return max(a, b, key=chain.index)
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return DecimalType(digits, scale) if digits <= MAX_DIGITS else None
    return None


def widened(stored: StructType, coming: StructType, fixed: tuple[str, ...] = ()) -> StructType:
    """``stored``, with the types it needs for ``coming`` as well. Columns that only one of them has do not matter.

    A column without a common type is refused. So is one of ``fixed`` that would have to widen: rows are placed by the
    hash of their key, which differs between types. Narrower values for it are fine.
    """
    kinds = {f.name: f.dataType for f in coming}
    out = []
    for f in stored:
        kind = wider(f.dataType, kinds[f.name]) if f.name in kinds else f.dataType
        if kind is None or (f.name in fixed and kind != f.dataType):
            raise ValueError(f"{f.name} is {f.dataType.simpleString()}, not {kinds[f.name].simpleString()}")
        out.append(StructField(f.name, kind, f.nullable, f.metadata))
    return StructType(out)


def as_stored(rows: DataFrame, stored: StructType) -> DataFrame:
    """``rows`` with the types of ``stored`` in the columns that both have; see :func:`widened`."""
    kinds = {f.name: f.dataType for f in stored}
    other = [f.name for f in rows.schema if f.name in kinds and kinds[f.name] != f.dataType]
    return rows.withColumns({n: F.col(fx.quoted(n)).cast(kinds[n]) for n in other}) if other else rows
