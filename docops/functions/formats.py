"""Sizes, speeds and durations as text, as native column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units, the step between them, and milliseconds per duration unit.
SIZE_UNITS = ("B", "kB", "MB", "GB", "TB", "PB", "EB", "ZB", "YB")
SPEED_UNITS = ("B/s", "kB/s", "MB/s", "GB/s", "TB/s", "PB/s", "EB/s", "ZB/s", "YB/s")
DOC_SPEED_UNITS = ("dps", "kdps", "Mdps", "Gdps", "Tdps", "Pdps", "Edps", "Zdps", "Ydps")
UNIT_STEP = 1024
WORDS = {"d": "day", "H": "hour", "m": "minute", "s": "second"}
MILLIS_PER = {"d": 86_400_000, "H": 3_600_000, "m": 60_000, "s": 1_000, "S": 1}


def _format(value: Column, units: tuple[str, ...], whole: bool) -> Column:
    value = value.cast("long" if whole else "double")
    number = value.cast("double")

    def scaled(size: Column) -> Column:
        return (F.floor(number / size * 100) / F.lit(100.0)).cast("string")

    text = F.when(value <= 0, F.lit(None).cast("string"))
    text = text.when(value < UNIT_STEP, F.concat(value.cast("string"), F.lit(f" {units[0]}")))
    # A value moves to the next unit as soon as it is above step - 1 of the one below.
    for power, unit in enumerate(units[1:], 1):
        size = float(UNIT_STEP**power)
        if whole and size > 2.0**63:
            break
        text = text.when(number <= (UNIT_STEP - 1) * size, F.concat(scaled(F.lit(size)), F.lit(f" {unit}")))
    # Beyond the last unit the number goes on being divided and has no unit.
    beyond = F.ceil(F.log2(number / (UNIT_STEP - 1.0)) / 10)
    return text.otherwise(scaled(F.pow(F.lit(float(UNIT_STEP)), beyond)))


def fmt_size(value: Column, whole: bool = True) -> Column:
    """A byte count as ``1.5 kB``; null unless positive. ``whole=False`` takes doubles."""
    return _format(value, SIZE_UNITS, whole)


def fmt_speed(value: Column, whole: bool = True) -> Column:
    """Bytes per second as text."""
    return _format(value, SPEED_UNITS, whole)


def fmt_doc_speed(value: Column, whole: bool = True) -> Column:
    """Documents per second as text."""
    return _format(value, DOC_SPEED_UNITS, whole)


# One match per quoted literal, run of other characters, or single unit letter.
_PATTERN_PART = re.compile(r"'([^']*)(?:'|$)|([yMdHmsS])|([^'yMdHmsS]+)")


def fmt_duration(millis: Column, pattern: str) -> Column:
    """Milliseconds under a pattern of d H m s S and literals.

    The span is divided only among the units the pattern names. A unit repeated
    with nothing but literals between prints once; y and M print nothing; S after
    s has three digits.
    """
    pieces: list[tuple[str, str]] = []
    previous = None
    for quoted, unit, plain in _PATTERN_PART.findall(pattern):
        if unit:
            if unit != previous:
                pieces.append(("unit", unit))
            previous = unit
        elif quoted or plain:
            pieces.append(("text", quoted or plain))
    named = {piece for kind, piece in pieces if kind == "unit"}
    whole = millis.cast("long")
    amounts: dict[str, Column] = {}
    above = None
    for unit, size in MILLIS_PER.items():
        if unit in named:
            amounts[unit] = _parts_of(whole, size, above)
            above = size
    out: list[Column] = [F.lit("")]
    after_seconds = False
    for kind, piece in pieces:
        if kind == "text":
            out.append(F.lit(piece))
        elif piece in amounts:
            if piece == "S" and after_seconds:
                out.append(F.lpad(amounts[piece].cast("string"), 3, "0"))
            else:
                out.append(amounts[piece].cast("string"))
            after_seconds = piece == "s"
    return F.concat(*out)


def fmt_duration_words(millis: Column, suppress_leading: bool, suppress_trailing: bool) -> Column:
    """Milliseconds as ``1 day 2 hours``; zero parts at the chosen ends are left out.

    Without leading suppression the days are always printed.
    """
    whole, above, amounts = millis.cast("long"), None, []
    for unit in WORDS:
        amounts.append(_parts_of(whole, MILLIS_PER[unit], above))
        above = MILLIS_PER[unit]

    def any_of(columns: list[Column]) -> Column:
        return reduce(lambda a, b: a | b, [c != 0 for c in columns])

    shown = []
    for at, (amount, word) in enumerate(zip(amounts, WORDS.values())):
        begun = any_of(amounts[: at + 1]) if suppress_leading else F.lit(True)
        more = any_of(amounts[at:]) if suppress_trailing and (suppress_leading or at) else F.lit(True)
        name = F.when(amount == 1, f" {word}").otherwise(f" {word}s")
        shown.append(F.when(begun & more, F.concat(amount.cast("string"), name)))
    return F.when(whole.isNotNull(), F.concat_ws(" ", *shown))


def _parts_of(millis: Column, size: int, above: int | None = None) -> Column:
    """Whole parts of ``size`` in ``millis``, beyond whole parts of ``above``; keeps the sign."""
    rest = millis if above is None else millis % F.lit(above).cast("long")
    return F.call_function("div", rest, F.lit(size).cast("long"))
