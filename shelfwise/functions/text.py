"""Text, key and number cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType

from shelfwise.params import NO, RECENT_MARK, YES

# The characters that count as blank at the ends of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


# Not only blanks, with or without a ``nan`` among them.
FILLED = r"(?iU)^(?![\s\x1c-\x1f]*(?:nan[\s\x1c-\x1f]*)?\z)"


def strip(text: Column) -> Column:
    """Remove blanks of any kind from both ends (Spark's ``trim`` removes spaces only).

    Most texts start and end with a visible ASCII character and are passed as they are:
    trimming by a set of characters costs several times more than looking at two.
    """
    clean = F.left(text, F.lit(1)).between("!", "~") & F.right(text, F.lit(1)).between("!", "~")
    return F.when(clean, text).otherwise(F.btrim(text, F.lit(BLANKS)))


def is_filled(text: Column) -> Column:
    """Is a text, stripped or not, neither blank nor ``nan``? One look at it, for use in filters."""
    return text.rlike(FILLED)


def filled_text(bare: Column) -> Column:
    """A stripped text, or null where it is blank or spells ``nan``."""
    return F.when((bare != "") & (F.lower(bare) != "nan"), bare)


def key_text(value: Column, kind: DataType) -> Column:
    """A key as text; whole floating-point numbers must not turn into exponents."""
    if isinstance(kind, (DoubleType, FloatType)):
        whole = value == F.floor(value)
        return F.when(whole, value.cast("decimal(38,0)").cast("string")).otherwise(value.cast("string"))
    return value.cast("string")


def bare_key(value: Column, kind: DataType = StringType()) -> Column:
    """First step of a key: stripped text. Make it a column of its own, it is used repeatedly."""
    return strip(key_text(value, kind))


def normalize_key(bare: Column) -> Column:
    """Second step: blank and ``nan`` become null; ``123.0`` becomes ``123``."""
    whole = bare.endswith(".0") & bare.rlike(r"^\d+\.0$")
    return F.when(whole, F.left(bare, F.length(bare) - 2)).otherwise(filled_text(bare))


DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number_or_zero(value: Column, kind: DataType = StringType()) -> Column:
    """A double; what is not a plain decimal number becomes 0."""
    # A cast alone also takes the type suffixes and hexadecimal forms of program text.
    plain = F.when(value.rlike(DECIMAL), value)
    number = plain.try_cast("double") if isinstance(kind, StringType) else value.cast("double")
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Null when the denominator is 0 or either side is null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def yes_no(condition: Column) -> Column:
    return F.when(condition, YES).otherwise(NO)


def is_recent_arrival(rotation: Column) -> Column:
    """Does a rotation class name a recent arrival, of whatever horizon?"""
    return F.coalesce(F.lower(rotation).contains(RECENT_MARK), F.lit(False))
