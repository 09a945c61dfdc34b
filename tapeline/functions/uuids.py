"""Time-based row ids (version 1 UUIDs) as a native expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from RFC 4122: 100 ns ticks between 1582-10-15 and 1970-01-01, ticks per
# millisecond, and the version, variant and multicast bits.
_EPOCH_TICKS = 122192928000000000
_TICKS_PER_MS = 10000
_VERSION_1 = 0x1000
_VARIANT = 0x8000
_MULTICAST = 0x010000000000


def _hex(value: Column, digits: int) -> Column:
    return F.lower(F.lpad(F.hex(value), digits, "0"))


def time_uuid(millis: Column, *identity: Column) -> Column:
    """Version 1 UUID for the time `millis` (epoch milliseconds).

    It is a function of the time and the identity columns alone, so a replayed batch or a
    retried task writes the same id again. The identity fills the node and clock bits and picks
    the tick within the millisecond: about 74 bits keep the rows of one batch apart.
    """
    ticks = (
        millis * _TICKS_PER_MS
        + F.pmod(F.xxhash64(F.lit("tick"), *identity), F.lit(_TICKS_PER_MS))
        + F.lit(_EPOCH_TICKS)
    )
    spread = F.xxhash64(F.lit("node"), *identity)
    clock = F.shiftrightunsigned(spread, 48).bitwiseAND(F.lit(0x3FFF)).bitwiseOR(F.lit(_VARIANT))
    node = spread.bitwiseAND(F.lit(0xFFFFFFFFFFFF)).bitwiseOR(F.lit(_MULTICAST))
    return F.concat_ws(
        "-",
        _hex(ticks.bitwiseAND(F.lit(0xFFFFFFFF)), 8),
        _hex(F.shiftrightunsigned(ticks, 32).bitwiseAND(F.lit(0xFFFF)), 4),
        _hex(
            F.shiftrightunsigned(ticks, 48).bitwiseAND(F.lit(0x0FFF)).bitwiseOR(F.lit(_VERSION_1)),
            4,
        ),
        _hex(clock, 4),
        _hex(node, 12),
    )


def uuid_millis(uuid: Column) -> Column:
    """Epoch milliseconds held in a version 1 UUID."""
    digits = F.concat(F.substring(uuid, 16, 3), F.substring(uuid, 10, 4), F.substring(uuid, 1, 8))
    ticks = F.conv(digits, 16, 10).cast("bigint") - F.lit(_EPOCH_TICKS)
    whole = ticks - F.pmod(ticks, F.lit(_TICKS_PER_MS))
    return (whole / F.lit(_TICKS_PER_MS)).cast("bigint")
