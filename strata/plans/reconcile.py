"""Reconciliation of a source table with its landed copy.

A table is a multiset of rows, so its fingerprint must not depend on order or
files: the row count and the sums of two 64-bit row hashes (each summed as two
32-bit halves, which no group of under 2^31 rows can overflow). Equal multisets
have equal fingerprints; others differ but for a chance of about 2^-64.

Both sides are fingerprinted in one scan each, per window (a load window, a day,
an ingest hour) and key range. Windows and ranges that agree are done: nothing
else of them is read again or shuffled. Only rows of ranges that differ are
compared row by row.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: key ranges of a table, of equal width between the source's least and largest key
RANGES = 1024
_SALT = 0x5BD1E995


def _hashes(cols: Sequence[str]) -> list[Column]:
    # a NULL leaves the hash as it was, so which columns are NULL is hashed too
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    return [F.xxhash64(nulls, *cols), F.xxhash64(F.lit(_SALT), *cols, nulls)]


def fingerprint(cols: Sequence[str]) -> list[Column]:
    """Aggregates ``rows, f1 .. f4`` of the rows of a group."""
    out = [F.count(F.lit(1)).alias("rows")]
    for i, h in enumerate(_hashes(cols)):
        out += [F.sum(F.shiftrightunsigned(h, 32)).alias(f"f{2 * i + 1}"),
                F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"f{2 * i + 2}")]
    return out


def _ranged(df: DataFrame, window: Column, key: str, low: int, high: int, ranges: int) -> DataFrame:
    """Add ``_window`` and ``_range`` (-1: no key, or outside the source's)."""
    k = F.col(key).try_cast("bigint")
    width = max(1, -(-(high - low + 1) // ranges))
    at = F.when(k.between(low, high), F.floor((k - F.lit(low)) / F.lit(width))).otherwise(F.lit(-1))
    return df.withColumns({"_window": window, "_range": F.coalesce(at, F.lit(-1)).cast("int")})


class Reconciliation:
    """``source`` and ``landed`` have the same columns (the RAW contract's
    strings, say); ``window`` is an expression over them, ``key`` an integer
    column. ``cols`` are compared, all by default."""

    def __init__(self, source: DataFrame, landed: DataFrame, window: Column, key: str,
                 cols: Sequence[str] | None = None, ranges: int = RANGES):
        self.cols, self.key = list(cols or source.columns), key
        k = F.col(key).try_cast("bigint")
        least = source.agg(F.min(k), F.max(k)).first()  # one row
        low, high = (least[0], least[1]) if least[0] is not None else (0, 0)
        self.source, self.landed = (_ranged(df.select(*dict.fromkeys([*self.cols, key])), window, key, low, high, ranges)
                                    for df in (source, landed))

    def _ranges(self) -> DataFrame:
        """Both fingerprints of every (window, range), a missing one as zeros."""
        sides = [df.groupBy("_window", "_range").agg(*fingerprint(self.cols)).withColumn("_side", F.lit(i))
                 for i, df in enumerate((self.source, self.landed))]
        of = lambda c, i: F.coalesce(F.max(F.when(F.col("_side") == i, F.col(c))), F.lit(0))
        names = ["rows", "f1", "f2", "f3", "f4"]
        both = sides[0].unionByName(sides[1]).groupBy("_window", "_range").agg(
            *[of(c, i).alias(f"{c}_{i}") for c in names for i in (0, 1)])
        same = F.lit(True)
        for c in names:
            same = same & (F.col(f"{c}_0") == F.col(f"{c}_1"))
        return both.withColumn("same", same)

    def windows(self) -> DataFrame:
        """(window, source_rows, landed_rows, same): one row per window."""
        return self._ranges().groupBy("_window").agg(
            F.sum("rows_0").alias("source_rows"), F.sum("rows_1").alias("landed_rows"),
            F.min("same").alias("same")).withColumnRenamed("_window", "window")

    def differences(self) -> DataFrame:
        """(key, kind, source_rows, landed_rows) of every key with a row that
        the sides hold unequally often: ``lost`` (rows of the source are
        missing), ``doubled`` (rows of the source are there too often),
        ``added`` (rows that the source does not have) or ``changed`` (both).
        Counts are of the rows that differ. Row counts per distinct row are
        partial sums, so a row that is doubled a million times is one per task."""
        differ = self._ranges().where(~F.col("same")).select("_window", "_range")
        rows = [df.join(differ, (df["_range"] == differ["_range"]) & df["_window"].eqNullSafe(differ["_window"]), "left_semi")
                .withColumn("_side", F.lit(i)) for i, df in enumerate((self.source, self.landed))]
        side = lambda i: F.sum(F.when(F.col("_side") == i, 1).otherwise(0))
        counts = (rows[0].unionByName(rows[1]).groupBy(*dict.fromkeys([*self.cols, self.key]))
                  .agg(side(0).alias("s"), side(1).alias("l")).where(F.col("s") != F.col("l")))
        lost, more = F.max(F.col("s") > F.col("l")), F.max(F.col("l") > F.col("s"))
        known = F.max((F.col("l") > F.col("s")) & (F.col("s") > 0))
        kind = (F.when(lost & more, "changed").when(lost, "lost").when(known, "doubled").otherwise("added"))
        return counts.groupBy(F.col(self.key).alias("key")).agg(
            kind.alias("kind"), F.sum("s").alias("source_rows"), F.sum("l").alias("landed_rows"))


def landing(source: DataFrame, landed: DataFrame, table: str, window: Column, key: str) -> Reconciliation:
    """A source extract against what ``rawzone.read_raw`` gives of its landing,
    both by the RAW contract's strings."""
    from ..sources import rawzone
    return Reconciliation(rawzone.conform(source, table), rawzone.conform(landed, table), window, key)
