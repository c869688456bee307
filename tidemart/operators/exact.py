"""Whole numbers of any size as decimal text: conversion from hex, sums, decimal point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Digits of one limb: a limb times 2^24 stays far below 64 bits.
LIMB = 9
BASE = 10 ** LIMB
HEX_DIGITS = 6


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _cut(text: Column, size: int) -> Column:
    """Pieces of `size` characters, the last characters first; the last piece may be shorter."""
    count = F.ceil(F.length(text) / size).cast("int")
    return F.transform(
        F.sequence(F.lit(1), count),
        lambda i: F.substring(text, F.greatest(F.length(text) - i * size + 1, F.lit(1)),
                              F.least(F.lit(size), F.length(text) - (i - 1) * size)))


def _join(limbs: Column) -> Column:
    """Text of limbs, the least first."""
    return F.array_join(F.transform(F.reverse(limbs), lambda x: F.lpad(x.cast("string"), LIMB, "0")), "")


def _plain(text: Column) -> Column:
    return F.regexp_replace(text, "^0+(?=[0-9])", "")


def hex_to_decimal(digits: Column) -> Column:
    """Decimal text of hex digits, however many; limb by limb, nothing is rounded."""
    groups = F.reverse(F.transform(_cut(digits, HEX_DIGITS),
                                   lambda h: F.conv(h, 16, 10).cast("bigint")))

    def times_and_add(limbs: Column, group: Column) -> Column:
        start = F.struct(group.alias("carry"), F.array().cast("array<bigint>").alias("out"))

        def step(state: Column, limb: Column) -> Column:
            value = limb * _long(1 << 24) + state["carry"]
            return F.struct(F.floor(value / BASE).alias("carry"),
                            F.concat(state["out"], F.array(value % _long(BASE))).alias("out"))

        def end(state: Column) -> Column:
            return F.when(state["carry"] > 0, F.concat(state["out"], F.array(state["carry"]))
                          ).otherwise(state["out"])

        return F.aggregate(limbs, start, step, end)

    zero = F.array(_long(0))
    return _plain(_join(F.aggregate(groups, zero, times_and_add)))


def sum_texts(rows: DataFrame, by: list[str], amount: str, *others: Column) -> DataFrame:
    """`by`, the exact sum of the whole-number texts in `amount` as text, and other aggregates.

    Texts are cut in limbs of nine digits, limbs of one place are summed (combined before the
    shuffle) and carried once per group. Rows whose text is null add nothing; a group of such rows has a null sum.
    """
    limbs = (rows.where(F.col(amount).isNotNull())
             .select(*by, F.posexplode(_cut(F.col(amount), LIMB)).alias("__place", "__limb"))
             .groupBy(*by, "__place")
             .agg(F.sum(F.col("__limb").cast("decimal(18,0)")).alias("__total")))
    begin = F.struct(F.lit(0).cast("decimal(38,0)").alias("carry"),
                     F.array().cast("array<bigint>").alias("out"))

    def carry(state: Column, place: Column) -> Column:
        value = (place["__total"] + state["carry"]).cast("decimal(38,0)")
        low = F.pmod(value, F.lit(BASE).cast("decimal(38,0)"))
        high = ((value - low) / F.lit(BASE).cast("decimal(10,0)")).cast("decimal(38,0)")
        return F.struct(high.alias("carry"),
                        F.concat(state["out"], F.array(low.cast("bigint"))).alias("out"))

    places = F.array_sort(F.collect_list(F.struct("__place", "__total")))
    summed = limbs.groupBy(*by).agg(places.alias("__places"))
    text = F.aggregate("__places", begin, carry, lambda s: _plain(
        F.concat(s["carry"].cast("string"), _join(s["out"]))))
    summed = summed.select(*[F.col(c).alias(f"__{c}") for c in by], text.alias(amount))
    groups = rows.groupBy(*by).agg(*(others or [F.count("*").alias("__n")]))
    match = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    condition = match[0]
    for m in match[1:]:
        condition = condition & m
    return groups.join(summed, condition, "left").drop(*[f"__{c}" for c in by], "__n")


def shift_point(text: Column, places: int) -> Column:
    """The number divided by 10^places, by moving the decimal point."""
    padded = F.when(F.length(text) > places, text).otherwise(F.lpad(text, places + 1, "0"))
    return F.concat(F.substring(padded, F.lit(1), F.length(padded) - places), F.lit("."),
                    F.right(padded, F.lit(places)))
