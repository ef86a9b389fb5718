"""Money and rate expressions: parsing, rounding, display text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ledgerlens.schema import AMOUNT_SCALE, amount_type

# Exponent notation of up to 18 digits, which this type holds exactly.
_SHORT_POWER = r"^[+-]?[0-9]{1,9}([.][0-9]{0,9})?[eE][+-]?[0-9]$"
_POWER = T.DecimalType(38, 18)


def _exactly(text: Column, number: Column, scale: int, to: T.DataType, on_error: str) -> Column:
    """``number`` as ``to``; text that is no number, or that would be rounded,
    fails the query or becomes null.

    Rounding is seen in the text itself: decimals beyond ``scale`` must be 0, so
    no type's width hides them. Exponents are read if they are short.
    """
    number = F.trim(number)
    plain = number.rlike(rf"^[+-]?([0-9]+([.][0-9]{{0,{scale}}}0*)?|[.][0-9]{{1,{scale}}}0*)$" if scale else r"^[+-]?[0-9]+([.]0*)?$")
    value = number.try_cast(to)
    power = number.rlike(_SHORT_POWER) & (number.try_cast(_POWER) == value)
    fits = value.isNotNull() & (plain | F.coalesce(power, F.lit(False)))
    if on_error == "null":
        return F.when(fits, value)
    failed = F.raise_error(F.concat(F.lit(f"not {to.simpleString()}: "), text)).cast(to)
    return F.when(fits, value).when(text.isNotNull(), failed)


def parse_decimal_comma(text: Column | str, on_error: str = "fail", scale: int = AMOUNT_SCALE) -> Column:
    """``"139,12"`` to 139.12.

    Thousands separators are never guessed: ``"1.234,56"`` is an error, and so
    is a value with more decimals than ``scale``.
    """
    text = F.col(text) if isinstance(text, str) else text
    number = F.replace(text, F.lit(","), F.lit("."))
    return _exactly(text, number, scale, amount_type(scale), on_error)


def parse_whole(text: Column | str, on_error: str = "fail") -> Column:
    """``"17850"``, or ``"17850.0"`` as a float column was exported, to 17850."""
    text = F.col(text) if isinstance(text, str) else text
    # A long cast reads no ".0": the decimal has room for any long.
    value = _exactly(text, text, 0, T.DecimalType(20, 0), "null").try_cast(T.LongType())
    if on_error == "null":
        return value
    failed = F.raise_error(F.concat(F.lit("not bigint: "), text)).cast("long")
    return F.when(value.isNotNull() | text.isNull(), value).otherwise(failed)


def round_rate(rate: Column | str, places: int = 3) -> Column:
    """Half-even rounding, for display only."""
    return F.bround(rate, places)


def format_currency(amount: Column | str, symbol: str = "£") -> Column:
    return F.concat(F.lit(symbol), F.format_number(amount, 2))


def format_percent(rate: Column | str) -> Column:
    rate = F.col(rate) if isinstance(rate, str) else rate
    return F.concat(F.format_number(rate * 100, 0), F.lit("%"))


def heat_intensity(rate: Column | str, low: float = 0.0, high: float = 0.5) -> Column:
    """Rate clipped to [low, high] and scaled to [0, 1]; null stays null."""
    rate = F.col(rate) if isinstance(rate, str) else rate
    clipped = F.when(rate < low, low).when(rate > high, high).otherwise(rate)
    return (clipped - low) / (high - low)
