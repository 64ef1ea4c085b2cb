"""File names, reporting periods and counter codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The layout of a file name,
# OSS1_-0400_A20170807.1200-0400-1215-0400_SubNetwork=ROOT,SubNetwork=Area,MeContext=Node_statsfile.xml
ERIC_NAME = r"^([^_.]*)_([+-])(\d{2})\d{2}_[^.]*?(\d{8})\.(\d{4})([+-])(\d{2})\d{2}"
ERIC_SUB_NETWORK_KEY = "SubNetwork="
ERIC_ME_CONTEXT_KEY = "MeContext="
UNKNOWN_OSS = "Unknown"
MINUTE_LENGTH = len("yyyy-MM-dd HH:mm")


def base_name(path: Column) -> Column:
    """The last part of a path with ``/`` or ``\\`` separators; the path itself if that part is empty."""
    last = F.substring_index(F.translate(path, "\\", "/"), "/", -1)
    return F.coalesce(F.nullif(last, F.lit("")), path)


def _name_part(path: Column, group: int) -> Column:
    return F.nullif(F.regexp_extract(base_name(path), ERIC_NAME, group), F.lit(""))


def _signed_hours(sign: Column, digits: Column) -> Column:
    hours = digits.try_cast("int")
    return F.when(sign == "-", -hours).otherwise(hours)


def eric_oss(path: Column) -> Column:
    return F.coalesce(_name_part(path, 1), F.lit(UNKNOWN_OSS))


def eric_own_offset(path: Column) -> Column:
    """Whole hours of the element's own UTC offset."""
    return _signed_hours(_name_part(path, 2), _name_part(path, 3))


def eric_file_time(path: Column) -> Column:
    """Start of the period as written in the name, before any shift."""
    day, clock = _name_part(path, 4), _name_part(path, 5)
    text = F.concat(
        F.substring(day, 1, 4), F.lit("-"), F.substring(day, 5, 2), F.lit("-"), F.substring(day, 7, 2),
        F.lit(" "), F.substring(clock, 1, 2), F.lit(":"), F.substring(clock, 3, 2), F.lit(":00"),
    )
    return text.try_cast("timestamp_ntz")


def eric_file_offset(path: Column) -> Column:
    """Whole hours of the UTC offset the start time was written in."""
    return _signed_hours(_name_part(path, 6), _name_part(path, 7))


def _comma_part(path: Column, index: int) -> Column:
    return F.get(F.split(base_name(path), ","), F.lit(index))


def eric_sub_network(path: Column) -> Column:
    return F.substr(_comma_part(path, 1), F.lit(len(ERIC_SUB_NETWORK_KEY) + 1))


def eric_me_context(path: Column) -> Column:
    return F.substring_index(F.substr(_comma_part(path, 2), F.lit(len(ERIC_ME_CONTEXT_KEY) + 1)), "_", 1)


def period_to_local(file_time: Column, file_offset: Column, own_offset: Column) -> Column:
    """Local start: back to UTC by the file's offset, then to the element's own offset.

    Whole hours only. Minutes of an offset such as ``+0530`` are not applied, which
    is what keeps ``hour_bucket`` of the local time equal to the local hour.
    """
    return F.timestamp_add("HOUR", own_offset - file_offset, file_time)


def hour_bucket(start: Column) -> Column:
    """Start of the hour. ``date_trunc`` would go through the session's time zone and its gaps."""
    return F.timestamp_add("SECOND", -(F.minute(start) * 60 + F.second(start)), start)


def nokia_oss(path: Column) -> Column:
    return F.substring_index(base_name(path), "_", 1)


def nokia_start(start_time: Column) -> Column:
    """The first 16 characters of ``startTime``; offset and seconds are dropped."""
    return F.replace(F.substring(start_time, 1, MINUTE_LENGTH), F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")


def nokia_duration(interval: Column) -> Column:
    return F.trim(interval).try_cast("int")


def minute_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm`` of a wall-clock time, whatever the session's time zone."""
    return F.substring(ts.cast("string"), 1, MINUTE_LENGTH)


def canonical_counter(code: Column) -> Column:
    """UMTS counter codes are compared in lower case; other element names keep theirs."""
    return F.when(code.startswith("M"), F.lower(code)).otherwise(code)


def canonical_code(code: str) -> str:
    """The same for a code that the driver holds."""
    return code.lower() if code.startswith("M") else code


def canonical_type(meas_type: Column) -> Column:
    return F.lower(meas_type)
