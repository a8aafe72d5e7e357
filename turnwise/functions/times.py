"""Date, time and number functions on columns. Zones are always named, never the session's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnwise.functions import let

# Fixed value: the home zone; every other zone takes the US locale.
HOME_ZONE = "Asia/Kolkata"


def local_day(reftime: Column) -> Column:
    """DT-1: the calendar day as written in the ISO text, without any zone shift."""
    return F.date_format(F.substring(reftime, 1, 10).try_cast("date"), "yyyy-MM-dd")


def ref_epoch_ms(reftime: Column, tz: str) -> Column:
    """DT-2: drop the offset, read the wall clock in ``tz``, epoch milliseconds."""
    bare = F.regexp_replace(reftime, r"(Z|[+-][0-9]{2}:?[0-9]{2})$", "")

    def instant(wall: Column) -> Column:
        names = ("YEAR", "MONTH", "DAY", "HOUR", "MINUTE", "SECOND")
        parts = [F.date_part(F.lit(name), wall) for name in names]
        return F.unix_millis(F.make_timestamp(*parts, F.lit(tz)))

    return let(bare.try_cast("timestamp_ntz"), instant)


def _offset(minutes: Column) -> Column:
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    sign = F.when(minutes < 0, "-").otherwise("+")
    size = F.abs(minutes)
    return F.concat(sign, two(F.floor(size / 60)), F.lit(":"), two(size % 60))


def iso_in_zone(epoch_ms: Column, tz: str) -> Column:
    """ISO text of an instant in ``tz``, with its offset; null if it is out of range."""

    def written(ms: Column) -> Column:
        # The session zone goes in and out again, so it does not matter which one it is.
        session = F.timestamp_millis(ms).cast("timestamp_ntz")
        utc = F.convert_timezone(None, F.lit("UTC"), session)
        fraction = lambda wall: F.when(F.pmod(ms, F.lit(1000)) == 0, "").otherwise(
            F.date_format(wall, ".SSSSSS")
        )
        return let(
            F.convert_timezone(None, F.lit(tz), session),
            lambda wall: F.concat(
                F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"),
                fraction(wall),
                let(F.timestamp_diff("MINUTE", utc, wall), _offset),
            ),
        )

    # Years 1 to 9999 are what the text form can hold.
    return let(F.when(epoch_ms.between(-62135596800000, 253402300799999), epoch_ms), written)


def duration_end(ref_ms: Column, seconds: Column, tz: str) -> Column:
    """DT-3: reference instant plus a duration in seconds, as ISO text in ``tz``."""
    return iso_in_zone((ref_ms + seconds.cast("bigint") * 1000).cast("bigint"), tz)


def entity_locale(language: Column, tz: str) -> Column:
    """DT-4: locale sent to the entity service."""
    if tz != HOME_ZONE:
        return F.when(language.isNotNull(), "en_US")
    return (
        F.when(language.contains("US"), "en_US")
        .when(language.startswith("en"), "en_IN")
        .otherwise(language)
    )


def sequence_probability(logprobs: Column) -> Column:
    """MTH-1: exp of the sum of all log probabilities but the last three."""
    kept = F.slice(logprobs, F.lit(1), F.greatest(F.size(logprobs) - 3, F.lit(0)))
    return F.exp(F.aggregate(kept, F.lit(0.0), lambda total, x: total + x.cast("double")))
