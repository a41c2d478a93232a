"""Data-quality checks and column profiles as aggregate jobs.

Every check is a distributed aggregate returning one row
``(check, violations)``; ``run_checks`` unions them so a single action
evaluates them all. Foreign keys are checked with a left anti join
(orphans), uniqueness with a partial-aggregated group count. A ``Suite`` takes
the checks of several tables together and shares scans and shuffles.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one(name: str, violations) -> DataFrame:
    return violations.select(F.lit(name).alias("check"),
                             F.col("_n").cast("bigint").alias("violations"))


def not_null(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    v = df.agg(F.count(F.when(F.col(col).isNull(), 1)).alias("_n"))
    return _one(name or f"not_null:{col}", v)


def unique(df: DataFrame, keys: Sequence[str], name: str | None = None) -> DataFrame:
    """Number of key groups occurring more than once."""
    v = (df.groupBy(*keys).count().where(F.col("count") > 1)
         .agg(F.count(F.lit(1)).alias("_n")))
    return _one(name or f"unique:{','.join(keys)}", v)


def foreign_key(child: DataFrame, col: str, parent: DataFrame, parent_col: str,
                name: str | None = None) -> DataFrame:
    """Child rows with a non-null key absent from the parent. Rows are counted
    per key first (partially, so a hot key is one row per task), and only the
    counts meet the parent."""
    p = parent.select(F.col(parent_col).alias("_pk"))
    c = (child.select(F.col(col).alias("_ck")).where(F.col("_ck").isNotNull())
         .groupBy("_ck").agg(F.count(F.lit(1)).alias("_rows")))
    v = c.join(p, c._ck == p._pk, "left_anti").agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("_n"))
    return _one(name or f"fk:{col}", v)


def in_range(df: DataFrame, col: str, lo=None, hi=None, name: str | None = None) -> DataFrame:
    c = F.col(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < F.lit(lo))
    if hi is not None:
        bad = bad | (c > F.lit(hi))
    v = df.agg(F.count(F.when(bad, 1)).alias("_n"))
    return _one(name or f"range:{col}", v)


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


class Suite:
    """Checks evaluated together.

    * Row checks of one table (not null, range, accepted values) are counters
      of one aggregate: the table is scanned once for all of them.
    * Uniqueness checks of all tables go through one shuffle of their keys.
    * Foreign keys of all tables go through one aggregate of bits: a key is a
      bit of a 64-bit word, so what a task holds and shuffles is one fixed-size
      row for 64 neighbouring keys (sparse keys: one each), in a hash table that
      spills. Bits that only children have are the orphans, exactly; where there
      are none, nothing else is done. The children's rows then meet these words
      once, and are counted. (``buckets`` bounded an earlier form; it changes
    nothing.)
    """

    def __init__(self, buckets: int | None = None):
        self._rows: dict[int, tuple[DataFrame, list]] = {}
        self._unique: list = []
        self._fks: list = []

    def _row(self, df: DataFrame, name: str, bad: Column) -> Suite:
        self._rows.setdefault(id(df), (df, []))[1].append((name, bad))
        return self

    def not_null(self, df: DataFrame, col: str, name: str | None = None) -> Suite:
        return self._row(df, name or f"not_null:{col}", F.col(col).isNull())

    def in_range(self, df: DataFrame, col: str, lo=None, hi=None, name: str | None = None) -> Suite:
        bad = F.lit(False)
        for bound, wrong in ((lo, lambda x: F.col(col) < x), (hi, lambda x: F.col(col) > x)):
            bad = bad if bound is None else bad | wrong(F.lit(bound))
        return self._row(df, name or f"range:{col}", bad)

    def accepted(self, df: DataFrame, col: str, values: Sequence, name: str | None = None) -> Suite:
        """Non-null values outside ``values``."""
        return self._row(df, name or f"accepted:{col}", F.col(col).isNotNull() & ~F.col(col).isin(*values))

    def unique(self, df: DataFrame, keys: Sequence[str], name: str | None = None) -> Suite:
        """Key groups (NULL is a value) that occur more than once."""
        self._unique.append((name or f"unique:{','.join(keys)}", df, list(keys)))
        return self

    def foreign_key(self, child: DataFrame, col: str, parent: DataFrame, parent_col: str,
                    name: str | None = None) -> Suite:
        """Child rows with a non-null key (an integer) absent from the parent."""
        self._fks.append((name or f"fk:{col}", child, col, parent, parent_col))
        return self

    def run(self) -> DataFrame:
        """(check, violations), one row per check."""
        parts = [self._row_checks(df, rules) for df, rules in self._rows.values()]
        if self._unique:
            parts.append(self._unique_checks())
        if self._fks:
            parts.append(self._fk_checks())
        return reduce(DataFrame.unionByName, parts)

    @staticmethod
    def _row_checks(df: DataFrame, rules: list) -> DataFrame:
        one = df.agg(*[F.count(F.when(bad, 1)).alias(f"n{i}") for i, (_, bad) in enumerate(rules)])
        return one.select(F.explode(F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"n{i}").alias("violations"))
                                              for i, (name, _) in enumerate(rules)])).alias("r")).select("r.*")

    @staticmethod
    def _totals(found: DataFrame, names: list[str]) -> DataFrame:
        """Violations per check, zero where ``found`` (check, n) has none."""
        none = found.sparkSession.createDataFrame([(n, 0) for n in names], "check string, n long")
        return found.unionByName(none).groupBy("check").agg(F.sum("n").cast("bigint").alias("violations"))

    def _unique_checks(self) -> DataFrame:
        keys = [df.select(F.lit(name).alias("check"), F.array(*[F.col(k).cast("string") for k in cols]).alias("k"))
                for name, df, cols in self._unique]
        twice = (reduce(DataFrame.unionByName, keys).groupBy("check", "k").agg(F.count(F.lit(1)).alias("n"))
                 .where(F.col("n") > 1).select("check", F.lit(1).cast("bigint").alias("n")))
        return self._totals(twice, [name for name, *_ in self._unique])

    def _keys(self, child: bool) -> DataFrame:
        """(check, key) of the non-null keys of one side; ``check`` is the number
        of the foreign key."""
        sides = []
        for i, (_, *sources) in enumerate(self._fks):
            df, c = sources[:2] if child else sources[2:]
            sides.append(df.select(F.lit(i).alias("check"), F.col(c).cast("bigint").alias("key"))
                         .where(F.col("key").isNotNull()))
        return reduce(DataFrame.unionByName, sides)

    def _fk_checks(self) -> DataFrame:
        children, none = self._keys(True), F.lit(0).cast("bigint")
        word = F.shiftright("key", 6).alias("word")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("key").bitwiseAND(63).cast("int"))
        sides = children.select("check", word, bit.alias("child"), none.alias("parent")).unionByName(
            self._keys(False).select("check", word, none.alias("child"), bit.alias("parent")))
        words = (sides.groupBy("check", "word").agg(F.bit_or("child").alias("child"), F.bit_or("parent").alias("parent"))
                 .select("check", "word", F.col("child").bitwiseAND(F.bitwise_not("parent")).alias("bits"))
                 .where(F.col("bits") != 0))
        place = F.sequence(F.lit(0), F.lit(63))
        orphans = words.select("check", F.explode(F.transform(
            F.filter(place, lambda i: F.getbit("bits", i) == 1),
            lambda i: F.call_function("shiftleft", F.col("word"), F.lit(6)) + i)).alias("key"))
        # rows are counted per key before they meet the orphans, so a hot key is
        # one row per task; an inner join (orphans are distinct): a semi join
        # would be pushed into every branch of the union
        counted = children.groupBy("check", "key").agg(F.count(F.lit(1)).alias("n"))
        found = counted.join(orphans, ["check", "key"]).groupBy("check").agg(F.sum("n").alias("n"))
        names = F.array(*[F.lit(fk[0]) for fk in self._fks])
        return self._totals(found.select(F.get(names, F.col("check")).alias("check"), "n"), [fk[0] for fk in self._fks])


def profile(df: DataFrame, cols: Sequence[str] | None = None, *, approx: bool = False,
            rsd: float = 0.01) -> DataFrame:
    """Per column: rows, nulls, distinct values, min and max (as strings).

    Values are unpivoted to (column, value) and aggregated per column. The
    exact distinct count is planned as a partial aggregate on (column,
    value), so a hot value is reduced map-side, but every distinct value of
    a key column is shuffled once; ``approx=True`` uses HyperLogLog++
    sketches instead (``approx_count_distinct``, relative error ``rsd``),
    which merge map-side into one small sketch per column.
    """
    cols = list(cols or df.columns)
    if approx:
        # one wide aggregate of sketches: no unpivot, no per-value shuffle
        agg = df.agg(F.count(F.lit(1)).alias("rows"),
                     *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"n__{i}")
                       for i, c in enumerate(cols)],
                     *[F.approx_count_distinct(c, rsd).alias(f"d__{i}") for i, c in enumerate(cols)],
                     *[F.min(c).cast("string").alias(f"min__{i}") for i, c in enumerate(cols)],
                     *[F.max(c).cast("string").alias(f"max__{i}") for i, c in enumerate(cols)])
        return agg.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"n__{i}").alias("nulls"),
                     F.col(f"d__{i}").alias("distinct"), F.col(f"min__{i}").alias("min"),
                     F.col(f"max__{i}").alias("max")) for i, c in enumerate(cols)])).alias("p")
        ).select("p.*")
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in cols])).alias("kv")).select("kv.column", "kv.value")
    counts = long.groupBy("column").agg(F.count(F.lit(1)).alias("rows"),
                                        F.count(F.when(F.col("value").isNull(), 1)).alias("nulls"),
                                        F.count_distinct("value").alias("distinct"))
    # typed min/max in one wide aggregate (no shuffle beyond the final merge)
    mm = df.agg(*[F.min(c).cast("string").alias(f"min__{i}") for i, c in enumerate(cols)],
                *[F.max(c).cast("string").alias(f"max__{i}") for i, c in enumerate(cols)])
    mm_long = mm.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"min__{i}").alias("min"),
                 F.col(f"max__{i}").alias("max")) for i, c in enumerate(cols)])).alias("m")
    ).select("m.*")
    return counts.join(mm_long, "column")
