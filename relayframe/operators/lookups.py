"""Joins of large tables with lookup tables whose size has to be checked first."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# Largest lookup sent to every executor: 200,000 narrow rows are about 20 MB.
BROADCAST_ROWS = 200_000
# Rows of one key joined by one task: narrow rows, and rows that carry a payload.
NARROW_ROWS = 1_000_000
WIDE_ROWS = 10_000
# Largest bit table of keys, as a power of two, and the bits of one of its rows as a power of two:
# 2 million rows of two numbers on every executor.
TABLE_BITS, WORD_BITS = 27, 6


def fits_broadcast(lookup: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Counts at most ``max_rows + 1`` rows of the lookup."""
    return lookup.limit(max_rows + 1).count() <= max_rows


def hot_keys(df: DataFrame, on: list[str], rows_per_task: int) -> DataFrame:
    """Keys with more rows than one task should join, and the tasks each of them needs."""
    n_salts = F.ceil(F.count("*") / rows_per_task).cast("int").alias("n_salts")
    return df.groupBy(*on).agg(n_salts).filter(F.col("n_salts") > 1)


def bounded_hot_keys(make: Callable[[int], DataFrame], per_task: int,
                     max_rows: int = BROADCAST_ROWS) -> DataFrame | None:
    """Hot keys as a table small enough to broadcast, or None if there are none.

    ``make`` lists the keys that exceed a share per task. Should there be too many, the
    share is raised: the more keys are hot, the less each of them stands out.
    """
    while True:
        # Written before it is counted: the rows are counted by key once.
        hot = cut_lineage(make(per_task).limit(max_rows + 1), "hot-keys")
        found = hot.count()
        if found <= max_rows:
            return hot if found else None
        per_task *= 8


class BitTable:
    """Which keys a large lookup may have: a bit for the hash of each, in a table of bounded size.

    It is sent to every executor, so rows without a key in it are told apart before a shuffle.
    Other keys can share a bit, which only adds work: who passes still has to be joined.
    """

    def __init__(self, hashes: DataFrame, n_keys: int, most: int = TABLE_BITS):
        """``hashes``: one column with ``xxhash64`` of the keys, ``n_keys`` of them."""
        self.bits = min(most, max(10, (16 * n_keys).bit_length()))
        word, bit = self._place(F.col(hashes.columns[0]))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
        self.table = cut_lineage(
            hashes.select(word.alias("_word"), one.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits")), "bits")

    def _place(self, hashed: Column) -> tuple[Column, Column]:
        place = F.shiftrightunsigned(hashed, 64 - self.bits)
        return F.shiftright(place, WORD_BITS), place.bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")

    def flag(self, df: DataFrame, key: Column, name: str) -> DataFrame:
        """``df`` with the boolean column ``name``: whether ``key`` may be among the keys; false for null."""
        word, bit = self._place(F.xxhash64(key))
        joined = df.withColumn("_word", F.when(key.isNotNull(), word)).join(F.broadcast(self.table), "_word", "left")
        held = F.call_function("shiftright", F.col("_bits"), bit).bitwiseAND(F.lit(1)) == 1
        return joined.withColumn(name, F.coalesce(held, F.lit(False))).drop("_word", "_bits")


def salted_join(many: DataFrame, one: DataFrame, on: list[str], how: str, hot: DataFrame | None,
                spread_by: Column, hint: str = "", hot_on: list[str] | None = None) -> DataFrame:
    """``many`` joined with ``one`` where the keys in ``hot`` are spread over ``n_salts`` tasks.

    ``hot`` comes from ``bounded_hot_keys``. Only rows of hot keys are copied; all other keys
    join as usual, and without any hot key this is the plain join. ``hint`` is for ``many``.
    ``hot_on`` names columns of both sides, functions of the key, by which ``hot`` lists keys instead.
    """
    keys, left, right, listed = on, many, one, hot_on or on
    if hot is not None:
        few = F.broadcast(hot)
        salts = F.coalesce(F.col("n_salts"), F.lit(1))
        left = many.join(few, listed, "left").withColumn(
            "_salt", F.pmod(F.xxhash64(spread_by), salts).cast("int")).drop("n_salts")
        right = one.join(few, listed, "left").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("n_salts")
        keys = [*on, "_salt"]
    if hot_on:
        left, right = left.drop(*hot_on), right.drop(*hot_on)  # no more needed, and not to be moved
    if hint:
        left = left.hint(hint)
    return left.join(right, keys, how).drop("_salt")


def join_lookup(
    big: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    *,
    spread_by: Column,
    rows_per_task: int = NARROW_ROWS,
    max_rows: int = BROADCAST_ROWS,
    write_lookup: bool = False,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """``big`` joined with a narrow ``lookup`` on equally named columns.

    A lookup within ``max_rows`` is broadcast, so ``big`` is not shuffled. Beyond that both
    are shuffled, and the keys of which ``big`` has more than ``rows_per_task`` rows are
    spread over several tasks; ``spread_by`` (a row identifier of ``big``) picks the one.
    ``write_lookup`` is for a lookup that takes work to compute: it is written first, so
    that counting it and joining it do not compute it twice. Keys are counted by their hashes, of
    less than half their bytes, and in ``count_in``, rows with the same keys as ``big``, where ``big``
    takes work to compute.
    """
    if write_lookup:
        lookup = cut_lineage(lookup, "lookup")
    if fits_broadcast(lookup, max_rows):
        return big.join(F.broadcast(lookup), on, how)
    hashed = F.xxhash64(*on).alias("_hash")
    counted = (big if count_in is None else count_in).select(hashed)
    hot = bounded_hot_keys(lambda share: hot_keys(counted, ["_hash"], share), rows_per_task)
    return salted_join(big.select("*", hashed), lookup.select("*", hashed), on, how, hot, spread_by, hot_on=["_hash"])


def latest_by(df: DataFrame, key: list[str], order: list[str], values: list[str]) -> DataFrame:
    """The row of each key that comes last in ``order``.

    An aggregate, not a window: it is combined before the shuffle, so a key that
    holds a large share of the rows costs no single task.
    """
    picked = F.max(F.struct(*order, *[v for v in values if v not in order])).alias("_last")
    return df.groupBy(*key).agg(picked).select(*key, *[f"_last.{v}" for v in values])
