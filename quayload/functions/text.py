"""Column functions on text. All are built-in expressions and stay in codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayload.functions.columns import column
from quayload.spec import DIGIT_WORDS, quote

# Each escape is a backslash and one letter, so decoding in reverse order is
# unambiguous, and no encoded text can ever equal the null marker ``\N``.
LINE_FEED = ("\n", "\\n")
LINE_ESCAPES = (("\\", "\\s"), LINE_FEED, ("\r", "\\r"), ("\0", "\\z"))


def _literal(text: str) -> str:
    """SQL for a text that reads the same whatever the session's escape setting."""
    return f"r'{text}'" if text.isprintable() else f"char({ord(text)})"


def _replacing(pairs: Sequence[tuple[str, str]], line_feed: tuple[str, str]) -> str:
    """SQL that replaces in turn, but only what occurs.

    Looking for a text is far cheaper than replacing it, and most values need
    nothing or line feeds only. ``{}`` stands for the column.
    """
    everything, only_feed = "{}", ""
    for pair in pairs:
        old, new = map(_literal, pair)
        everything = f"replace({everything}, {old}, {new})"
        if pair == line_feed:
            only_feed = f"WHEN contains({{}}, {old}) THEN replace({{}}, {old}, {new})"
    others = " OR ".join(f"contains({{}}, {_literal(old)})" for old, new in pairs if (old, new) != line_feed)
    return f"CASE WHEN {others} THEN {everything} {only_feed} ELSE {{}} END"


_ESCAPE = _replacing(LINE_ESCAPES, LINE_FEED)
_UNESCAPE = "CASE WHEN contains({}, %s) THEN %s ELSE {} END" % (
    _literal("\\"),
    _replacing([pair[::-1] for pair in reversed(LINE_ESCAPES)], LINE_FEED[::-1]),
)


def escape_lines(name: str) -> Column:
    """A text column encoded to hold no line break, no NUL and no lone backslash.

    Built as one SQL text: a wide table has hundreds of these, and each would
    otherwise take dozens of calls to the JVM to put together.
    """
    return F.expr(_ESCAPE.replace("{}", quote(name)))


def unescape_lines(name: str) -> Column:
    """The inverse of :func:`escape_lines`."""
    return F.expr(_UNESCAPE.replace("{}", quote(name)))


def compose_query_key(fields: Sequence[str]) -> Column:
    """The lookup text of one or more fields, or null when nothing is left.

    Upper case, every run of other characters than ``A-Z0-9`` as one space,
    no space at either end. Null fields are skipped.
    """
    if not fields:
        raise ValueError("at least one query field is needed")
    joined = F.concat_ws(" ", *[column(name) for name in fields])
    normal = F.trim(F.regexp_replace(F.upper(joined), "[^A-Z0-9]+", " "))
    return F.nullif(normal, F.lit(""))


def spell_digits(name: Column) -> Column:
    """All-digit names as words (``311`` is ``threeoneone``), other names unchanged.

    A digit name with a zero gives null, because a zero has no spelling and
    leaving it out would make ``10`` equal to ``1``.
    """
    words = name
    for digit, word in DIGIT_WORDS.items():
        words = F.replace(words, F.lit(digit), F.lit(word))
    return (
        F.when(name.rlike(r"\A[1-9]+\z"), words)
        .when(name.rlike(r"\A[0-9]+\z"), F.lit(None).cast("string"))
        .otherwise(name)
    )


def point_wkt(lon: Column, lat: Column) -> Column:
    """``POINT (lon lat)`` with six decimals, null when either number is null."""
    x, y = (number.cast("decimal(9,6)").cast("string") for number in (lon, lat))
    return F.concat(F.lit("POINT ("), x, F.lit(" "), y, F.lit(")"))
