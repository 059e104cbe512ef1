"""CDC value decoders (and the matching encoders used to build wire fixtures).

Every decoder takes the JSON value as text (``from_json`` into a STRING field
keeps numbers as their literal text) and never raises: unknown shapes give
null. All are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Text that is a number: decimal digits with an optional point and exponent, or a named one.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"

# Characters of base64 that no decimal number has.
NO_NUMBER = r"[A-DF-Za-df-z/=]"


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_epoch_date(c: Column | str) -> Column:
    """Days since 1970-01-01 -> DATE; ISO date text passes through; else null."""
    c = _c(c)
    return F.coalesce(F.date_from_unix_date(c.try_cast("int")), c.try_cast("date"))


def decode_decimal(c: Column | str, precision: int = 10, scale: int = 2) -> Column:
    """Money in any of the CDC encodings -> DECIMAL(precision, scale).

    1. number or numeric text ('299.00', '299')
    2. base64 of the big-endian two's-complement unscaled integer ('dMw=' is
       0x74CC = 29900 -> 299.00), 1 to 16 bytes; the sign comes from the top bit.
       Text that reads as a number (NUMBER) is never taken for base64; text such
       as '100D', which only a parser of Java literals takes for one, is.
    Anything else (bad padding, more than DECIMAL holds) is null.
    """
    c = _c(c)
    target = f"decimal({precision},{scale})"
    # a failed cast costs an exception: text with one of these characters is no number for it
    as_number = F.when(~c.rlike(NO_NUMBER), c.try_cast(target))
    h = F.hex(F.try_to_binary(c, F.lit("base64")))
    sign_fill = F.when(F.substring(h, 1, 1) >= F.lit("8"), F.lit("F")).otherwise(F.lit("0"))
    # two 64-bit halves, the upper one signed; the sum is null beyond 38 digits
    full = F.lpad(h, 32, sign_fill)
    upper = F.conv(F.substring(full, 1, 16), 16, -10).try_cast("decimal(20,0)")
    lower = F.conv(F.substring(full, 17, 16), 16, 10).try_cast("decimal(20,0)")
    half = F.lit("18446744073709551616").cast("decimal(20,0)")
    unscaled = F.try_add(F.try_multiply(upper, half), lower).cast("string")
    as_bytes = F.when(
        ~c.rlike(NUMBER) & (F.length(h) >= 2) & (F.length(h) <= 32) & (F.length(c) % 4 == 0),
        F.concat(unscaled, F.lit(f"E-{scale}")).try_cast(target),
    )
    return F.coalesce(as_number, as_bytes)


def decode_flag(c: Column | str) -> Column:
    """0/1 (or JSON booleans) -> BOOLEAN. Any numeric zero ('0', '0.0'),
    false, '' and null are false; everything else is true."""
    c = _c(c)
    v = F.lower(F.trim(c))
    zero = F.coalesce(v.try_cast("double") == F.lit(0.0), F.lit(False))
    return F.when(c.isNull() | v.isin("false", "") | zero, F.lit(False)).otherwise(F.lit(True))


def decode_timestamp(c: Column | str) -> Column:
    """Epoch millis, or ISO text, -> TIMESTAMP_NTZ holding the UTC wall clock.

    Zoned text ('...Z', '+02:00') is converted through the absolute instant, so
    the result does not depend on the session time zone.
    """
    c = _c(c)
    millis = c.try_cast("bigint")
    # years 1 to 9999; timestamp_add raises beyond them
    in_range = F.when(millis.between(-62_135_596_800_000, 253_402_300_799_999), millis)
    from_millis = F.timestamp_add("MILLISECOND", in_range, _epoch())
    zoned = F.timestamp_add("MICROSECOND", F.unix_micros(F.try_to_timestamp(c)), _epoch())
    has_zone = c.rlike(r"(Z|[+-]\d\d:?\d\d)$")
    from_text = F.when(has_zone, zoned).otherwise(c.try_cast("timestamp_ntz"))
    return F.when(millis.isNotNull(), from_millis).otherwise(from_text)


# ----------------------------------------------------------------- encoders

def encode_epoch_date(c: Column | str) -> Column:
    return F.unix_date(_c(c))


def encode_epoch_millis(c: Column | str) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> epoch millis, from the zone-free date
    and time fields (``timestamp_diff`` on NTZ passes through the session
    zone and is off by an hour for wall times in a DST gap)."""
    t = _c(c)
    return (F.unix_date(F.to_date(t)).cast("bigint") * 86400000 + F.hour(t) * 3600000 + F.minute(t) * 60000
            + F.floor(F.extract(F.lit("SECOND"), t) * 1000)).cast("bigint")


def encode_iso_utc(c: Column | str) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> '2025-03-07T00:00:00Z'. Built from the
    zone-free string form: ``date_format`` would pass through the session
    zone and move wall-clock times that fall in a DST gap."""
    return F.concat(F.regexp_replace(_c(c).cast("string"), " ", "T"), F.lit("Z"))


def encode_decimal_base64(c: Column | str, scale: int = 2) -> Column:
    """DECIMAL -> base64 of its minimal big-endian two's-complement unscaled value."""
    v = (_c(c) * F.lit(10 ** scale)).cast("bigint")
    h = F.hex(v)  # negative values come back as 16 hex digits (two's complement)
    even = F.when(F.length(h) % 2 == 1, F.concat(F.lit("0"), h)).otherwise(h)
    positive = F.when(F.substring(even, 1, 1) >= F.lit("8"), F.concat(F.lit("00"), even)) \
        .otherwise(even)
    # drop redundant leading FF bytes while the sign stays negative
    negative = F.regexp_replace(h, r"^(FF)+(?=[89A-F])", "")
    return F.base64(F.unhex(F.when(v < 0, negative).otherwise(positive)))
