"""Schema contracts and evolution.

``align(df, contract)`` makes a DataFrame fit a contract by *name*: missing
columns become typed NULLs, safe widenings (int → bigint, float → double,
any number → double, date → timestamp) are applied, and anything narrower or
incompatible is rejected. ``union_evolving`` unions two versions of a table
whose columns differ.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4,
         T.FloatType: 5, T.DoubleType: 6}


class SchemaMismatch(TypeError):
    pass


def _safe(src: T.DataType, dst: T.DataType) -> bool:
    if src == dst:
        return True
    rs, rd = _RANK.get(type(src)), _RANK.get(type(dst))
    if rs and rd:
        return rs <= rd
    if isinstance(src, T.DateType) and isinstance(dst, (T.TimestampType, T.TimestampNTZType)):
        return True
    if isinstance(dst, T.StringType) and isinstance(src, T.StringType):
        return True
    return False


def align(df: DataFrame, contract: T.StructType, *, allow_extra: bool = False) -> DataFrame:
    have = {f.name: f.dataType for f in df.schema.fields}
    extra = [c for c in have if c not in contract.fieldNames()]
    if extra and not allow_extra:
        raise SchemaMismatch(f"columns not in contract: {extra}")
    cols = []
    for f in contract.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif _safe(have[f.name], f.dataType):
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            raise SchemaMismatch(f"{f.name}: {have[f.name].simpleString()} cannot be narrowed "
                                 f"to {f.dataType.simpleString()}")
    return df.select(*cols)


def union_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; columns missing on one side are NULL there, and
    shared columns are widened to the wider type."""
    types = {f.name: f.dataType for f in old.schema.fields}
    for f in new.schema.fields:
        if f.name in types and not _safe(f.dataType, types[f.name]):
            if _safe(types[f.name], f.dataType):
                types[f.name] = f.dataType
            else:
                raise SchemaMismatch(f"{f.name}: {types[f.name]} vs {f.dataType}")
        elif f.name not in types:
            types[f.name] = f.dataType
    contract = T.StructType([T.StructField(n, t, True) for n, t in types.items()])
    return align(old, contract, allow_extra=False).unionByName(align(new, contract))
