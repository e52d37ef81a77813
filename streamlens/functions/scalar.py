"""Column functions. All are built-in expressions and stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KIB = 1024
HIGH_RISK, MEDIUM_RISK, REGULAR = "high-risk", "medium-risk", "regular-trading"


def field(text: Column, separator: str, number: int) -> Column:
    """The ``number``-th (from 0) part of ``text``, or empty when there are fewer parts."""
    return F.split_part(text, F.lit(separator), F.lit(number + 1))


def tokens(text: Column, pattern: str = r"\W+") -> Column:
    r"""Non-empty parts of ``text`` between matches of ``pattern``.

    The default yields words; ``\w+`` yields the separators.
    """
    return F.filter(F.split(text, pattern), lambda part: part != "")


def to_long(text: Column) -> Column:
    """Number in ``text``, or null when it is not one."""
    return text.try_cast("bigint")


def cents(amount: Column) -> Column:
    """Amount as whole cents, so that sums are exact in any order."""
    return F.round(amount * 100).cast("bigint")


def byte_length(text: Column) -> Column:
    return F.octet_length(text)


def human_bytes(size: Column) -> Column:
    """``1023B``, ``1.50KB``, ``1.00MB``: two decimals from 1 KB up, units to TB."""
    text = F.concat(size.cast("string"), F.lit("B"))
    for power, unit in enumerate(["KB", "MB", "GB", "TB"], start=1):
        scaled = F.call_function(
            "format_number", size / F.lit(float(KIB**power)), F.lit("###.00")
        )
        text = F.when(size >= F.lit(KIB**power), F.concat(scaled, F.lit(unit))).otherwise(text)
    return text


def risk_tier(amount: Column, medium: float = 50_000, high: float = 100_000) -> Column:
    """Tier by amount; both limits are exclusive."""
    return F.when(amount > high, HIGH_RISK).when(amount > medium, MEDIUM_RISK).otherwise(REGULAR)


def from_epoch(number: Column, unit: str) -> Column:
    """Epoch number to timestamp; ``unit`` is ``"s"`` or ``"ms"`` and has no default on purpose."""
    if unit == "s":
        return F.timestamp_seconds(number)
    if unit == "ms":
        return F.timestamp_millis(number)
    raise ValueError(f"unit must be 's' or 'ms', not {unit!r}")


def to_epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def first_known(*columns: Column) -> Column:
    """The first non-null of the columns."""
    return F.coalesce(*columns)


def day_text(ts: Column) -> Column:
    """``yyyyMMdd``."""
    return F.date_format(ts, "yyyyMMdd")


def run_window(run_day: Column) -> dict[str, Column]:
    """From a ``yyyyMMdd`` run day: the day processed, and the span of bulletins it covers."""
    day = F.to_date(run_day, "yyyyMMdd")
    before = F.date_sub(day, 1)
    start = F.concat(F.date_format(before, "yyyy-MM-dd"), F.lit(" 09:30:00"))
    end = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 08:00:00"))
    return {
        "execute_day": day_text(before),
        "start_time": start.cast("timestamp_ntz"),
        "end_time": end.cast("timestamp_ntz"),
    }


def month_start(day: Column) -> Column:
    """First day of the month of a ``yyyyMMdd`` text."""
    return F.concat(F.substring(day, 1, 6), F.lit("01"))


def smallest(values: Column, n: int) -> Column:
    """The ``n`` smallest entries of an array, ascending."""
    return F.slice(F.array_sort(values), 1, n)


def largest(values: Column, n: int) -> Column:
    """The ``n`` largest entries of an array, descending."""
    return F.slice(F.sort_array(values, asc=False), 1, n)


def without_first(values: Column) -> Column:
    return F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0)))


def map_put(entries: Column, key: Column, value: Column) -> Column:
    """Map with ``key`` set to ``value``, replacing an older entry."""
    rest = F.map_filter(entries, lambda k, _: k != key)
    return F.map_concat(rest, F.create_map(key, value))


def map_remove(entries: Column, key: Column) -> Column:
    return F.map_filter(entries, lambda k, _: k != key)
