"""Reading and writing text cells: null spellings, strict and lenient parsing, rendering."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.contract import LENIENT_NULL_TOKENS, NULL_TOKENS


def strip_bom(cell: Column) -> Column:
    return F.regexp_replace(cell, "^\ufeff+", "")


def null_if_token(cell: Column) -> Column:
    """NULL for any of the source null spellings, the cell otherwise."""
    return F.when(~cell.isin(*NULL_TOKENS), cell)


def strict_cell(cell: Column, kind: T.DataType) -> Column:
    """Typed cell; a spelling that is neither NULL nor of the type fails the job.

    Each cell is parsed once, and null spellings never: a parse that fails costs an exception.
    """
    present = null_if_token(cell)
    if isinstance(kind, T.StringType):
        return present
    bad = F.raise_error(F.concat(F.lit(f"not a {kind.simpleString()}: "), cell)).cast(kind)
    return F.coalesce(present.try_cast(kind), F.when(present.isNotNull(), bad))


def lenient_double(cell: Column) -> Column:
    text = F.trim(cell)
    return F.when(~F.lower(text).isin(*LENIENT_NULL_TOKENS), text.try_cast("double"))


def lenient_boolean(cell: Column) -> Column:
    return F.coalesce(F.lower(F.trim(cell)).isin("true", "t", "1"), F.lit(False))


def _six_digits(number: Column) -> Column:
    """A double below 2^63 with six decimals, rounded from its exact binary value, ties to even.

    A million times a number below 2^20 is off by 2^-14 at most. Where that lies farther from a half than 2^-12, which way it
    rounds is certain, and whole numbers do. Elsewhere the parts are taken apart, see :func:`_exact_six_digits`.
    """
    size = F.abs(number)
    scaled = size * 1e6
    certain = (size < 2.0**20) & (F.abs(scaled % 1.0 - 0.5) > 2.0**-12)
    plain = (F.rint(scaled).cast("long").cast("decimal(13,0)") * Decimal("0.000001")).cast("string")
    negative = (number <= 0) & F.startswith(number.cast("string"), F.lit("-"))
    return F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), F.when(certain, plain).otherwise(_exact_six_digits(size)))


def _exact_six_digits(size: Column) -> Column:
    """Six decimals of a number from 0 to 2^63.

    The remainder of a double by a power of two has no error. So the fraction falls into parts of 26, 20 and
    the remaining bits, each of which times a million is exact, and the sign of what lies above ``below`` and
    one half is certain. That moves the half up or down by a quarter, which ``rint`` then rounds.
    """
    fraction, low, lowest = size % 1.0, size % 2.0**-26, size % 2.0**-46
    below = F.floor(fraction * 1e6)
    above = (fraction - low) * 1e6 - below - 0.5 + (low - lowest) * 1e6 + lowest * 1e6
    millionths = F.rint(below + 0.5 + F.signum(above) * 0.25).cast("decimal(7,0)")
    return (F.floor(size).cast("decimal(20,0)") + millionths * Decimal("0.000001")).cast("string")


def render_cell(name: str, value: Column) -> Column:
    """One feature value as the contract files spell it: empty for NULL and NaN,
    True/False for the burst flag, integers for sample landmarks, six decimals otherwise."""
    if name == "is_burst":
        return F.when(value, F.lit("True")).otherwise(F.lit("False"))
    number = value.cast("double")
    missing = number.isNull() | F.isnan(number)
    if name.startswith("sample_"):
        text = value.cast("long").cast("string")
    else:
        text = F.when(F.abs(number) < 2.0**63, _six_digits(number)).otherwise(F.format_string("%.6f", number))
    return F.when(missing, F.lit("")).otherwise(text)
