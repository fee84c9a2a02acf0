"""Order columns in one number, and a small filter on numbers."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits that values of a type take; instants up to the year 38,000.
BITS = {
    T.TimestampType: 61,
    T.TimestampNTZType: 61,
    T.LongType: 64,
    T.IntegerType: 32,
    T.ShortType: 16,
    T.ByteType: 8,
}
#: What fits a decimal of 38 digits.
MOST_BITS = 126
FILTER_BITS = 1 << 20


def _whole(number: int) -> Column:
    return F.lit(Decimal(number)).cast("decimal(20,0)")


def packed_order(frame: DataFrame, order: Sequence[str]) -> Column | None:
    """One decimal that sorts as the ``order`` columns together do, nulls first; None if they don't fit.

    Least and greatest decimals are found in place by a hash aggregation, those of structs
    need sorted rows.
    """
    kinds = [type(frame.schema[name].dataType) for name in order]
    if any(kind not in BITS for kind in kinds) or sum(BITS[kind] for kind in kinds) > MOST_BITS:
        return None
    packed = None
    for name, kind in zip(order, kinds):
        instant = kind in (T.TimestampType, T.TimestampNTZType)
        value = F.unix_micros(F.col(name).cast("timestamp")) if instant else F.col(name)
        least = 1 << BITS[kind] - 1
        place = F.coalesce(value.cast("decimal(20,0)") + _whole(least), _whole(0))
        packed = place if packed is None else packed * _whole(1 << BITS[kind]) + place
    return packed.cast("decimal(38,0)")


def id_filter(ids: DataFrame, name: str, bits: int = FILTER_BITS) -> Callable[[Column], Column]:
    """A test that holds for every value of ``ids`` and for few others, as an expression of fixed size.

    Two bits stand for each id. Tasks combine their bits, and at most ``bits / 64`` numbers
    come to the driver, however many ids there are. With more ids than bits it lets
    everything pass, so it only ever saves work.
    """

    def slots(value: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(value, F.lit(seed)), F.lit(bits)) for seed in (0, 1)]

    one = F.lit(1).cast("bigint")
    set_bits = (
        ids.select(F.explode(F.array(*slots(F.col(name)))).alias("slot"))
        .groupBy(F.floor(F.col("slot") / 64).alias("at"))
        .agg(F.bit_or(F.call_function("shiftleft", one, (F.col("slot") % 64).cast("int"))).alias("bits"))
    )
    words = [0] * (bits // 64)
    for row in set_bits.collect():
        words[row["at"]] = row["bits"]
    # A constant: parsed once, when the plan is made.
    stored = F.from_json(F.lit(json.dumps(words)), "array<bigint>")

    def holds(value: Column) -> Column:
        test = F.lit(True)
        for slot in slots(value):
            word = F.get(stored, F.floor(slot / 64).cast("int"))
            test = test & (F.getbit(word, (slot % 64).cast("int")) == 1)
        return test

    return holds
