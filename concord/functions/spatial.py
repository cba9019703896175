"""Geometry bytes between EWKB and the form with a 4-byte SRID in front.

EWKB: byte order, 4-byte type with flag 0x20000000 if an SRID follows, SRID, rest.  All little-endian here; other bytes pass.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO = "00000000"


def to_ewkb(c: Column) -> Column:
    """SRID prefix -> EWKB: the SRID goes after the type and sets the flag; a zero SRID is dropped.  Too short or big-endian values pass."""
    h = F.hex(c)
    srid, order, kind, rest = F.substring(h, 1, 8), F.substring(h, 9, 2), F.substring(h, 11, 8), F.expr("''")
    rest = F.substring(h, 19, 1 << 30)
    flagged = F.concat(F.substring(kind, 1, 6), F.lpad(F.hex(F.conv(F.substring(kind, 7, 2), 16, 10).cast("long").bitwiseOR(F.lit(0x20))), 2, "0"))
    good = (F.length(c) >= 9) & (order == "01")
    return F.when(~good, c).when(srid == ZERO, F.unhex(F.substring(h, 9, 1 << 30))).otherwise(F.unhex(F.concat(order, flagged, srid, rest)))


def from_ewkb(c: Column) -> Column:
    """EWKB -> SRID prefix: the flag is cleared and the SRID moved to the front, zeros without one."""
    h = F.hex(c)
    order, kind = F.substring(h, 1, 2), F.substring(h, 3, 8)
    top = F.conv(F.substring(kind, 7, 2), 16, 10).cast("long")
    cleared = F.concat(F.substring(kind, 1, 6), F.lpad(F.hex(top.bitwiseAND(F.lit(0xDF))), 2, "0"))
    good = (F.length(c) >= 5) & (order == "01")
    with_srid = F.unhex(F.concat(F.substring(h, 11, 8), order, cleared, F.substring(h, 19, 1 << 30)))
    return F.when(~good, c).when(top.bitwiseAND(F.lit(0x20)) != 0, with_srid).otherwise(F.unhex(F.concat(F.lit(ZERO), h)))
