"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillmark.functions.time import col, timestamp_text


def _literal(separator: str) -> str:
    """A pattern that matches the separator itself. Plain characters stay bare, which splits faster."""
    return separator if separator in (" ", ",", "/", ";") else f"\\Q{separator}\\E"


def tokens(text: Column | str, separator: str = " ") -> Column:
    """Split on a literal separator, without the empty tokens at the end.

    Empty text is one empty token; text of nothing but separators has no token.
    """
    t = col(text)
    cut = F.rtrim(t) if separator == " " else F.regexp_replace(t, f"({_literal(separator)})+$", "")
    only_separators = (cut == "") & (t != "")
    return F.when(~only_separators, F.split(cut, _literal(separator)))


def split_text(text: Column | str, separator: str) -> Column:
    """Split on a literal separator; empty parts at the end are left out."""
    return tokens(text, separator)


def parse_long(text: Column | str) -> Column:
    """Trimmed text to bigint, null where it is no number; a trailing ``L`` is allowed."""
    return F.regexp_replace(F.trim(col(text)), "L$", "").try_cast("bigint")


def string_hash(text: Column | str) -> Column:
    """The 32-bit hash ``h = 31 * h + unit`` over the UTF-16 units of a string."""
    # One element per code point; those above the basic plane count as two units.
    points = F.transform(F.filter(F.split(col(text), ""), lambda c: c != ""), lambda c: F.ascii(c).cast("bigint"))
    top = F.lit(0x10000)

    def wrap(h: Column) -> Column:
        return F.shiftright(F.shiftleft(h, 32), 32)

    def step(h: Column, p: Column) -> Column:
        return wrap(h * 31 + p)

    def add(h: Column, p: Column) -> Column:
        high = F.shiftright(p - top, 10) + F.lit(0xD800)
        low = (p - top).bitwiseAND(F.lit(0x3FF)) + F.lit(0xDC00)
        return F.when(p < top, step(h, p)).otherwise(step(step(h, high), low))

    return F.aggregate(points, F.lit(0).cast("bigint"), add).cast("int")


def event_text(user: Column | str, url: Column | str, ms: Column | str) -> Column:
    """One-line text form of an event."""
    return F.format_string(
        "Event{username='%s', url='%s', timestamp=%s}", col(user), col(url), timestamp_text(ms)
    )


def window_text(label: Column | str, count: Column | str, start: Column | str, end: Column | str) -> Column:
    """One-line text form of a count in a window."""
    shown = "yyyy-MM-dd HH:mm:ss"
    return F.format_string(
        "%s: %d in [%s, %s)",
        col(label),
        col(count),
        F.date_format(col(start), shown),
        F.date_format(col(end), shown),
    )
