"""Exact decimals: text to ``decimal(18,8)`` with no rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schema import PRICE

UNIT = 100_000_000


def _fail(message: str, text: Column, data_type) -> Column:
    return F.raise_error(F.concat(F.lit(message + ": "), text)).cast(data_type)


def exact_decimal(text: Column) -> Column:
    """Text to price; more than eight significant fraction digits, or no number, raises."""
    bad = F.when(text.isNotNull(), _fail("not a decimal(18,8)", text, PRICE))
    return F.coalesce(try_exact_decimal(text), bad)


def try_exact_decimal(text: Column) -> Column:
    """Text to price, or NULL where it is no number or has more fraction digits than a price.

    Plain notation with up to eight fraction digits needs one cast. Anything else goes through
    a wider decimal and a look at the digits that would be lost.
    """
    dot = F.instr(text, ".")
    plain = ~(text.contains("e") | text.contains("E"))
    short = plain & ((dot == 0) | (F.length(text) - dot <= 8))
    wide = text.try_cast("decimal(38,20)")
    price = wide.try_cast(PRICE)
    exact = price.isNotNull() & (price == wide) & F.when(plain, ~text.rlike(r"\.\d{8}0*[1-9]")).otherwise(_fits(text))
    return F.coalesce(F.when(short, text.try_cast(PRICE)), F.when(exact, price))


def _fits(text: Column) -> Column:
    """Whether a number with an exponent has at most eight fraction digits, by its digits: a wide
    decimal may already have rounded them away."""
    parts = r"^\s*[+-]?(\d*)\.?(\d*)[eE]([+-]?\d+)[dDfF]?\s*$"
    fraction = F.regexp_extract(text, parts, 2)
    digits = F.concat(F.regexp_extract(text, parts, 1), fraction)
    zeros = F.length(digits) - F.length(F.rtrim(digits, F.lit("0")))
    places = F.length(fraction) - zeros - F.regexp_extract(text, parts, 3).try_cast("int")
    return (digits.rlike("^0+$")) | F.coalesce(places <= 8, F.lit(False))


def whole_number(text: Column) -> Column:
    """Text to bigint; anything else raises."""
    bad = F.when(text.isNotNull(), _fail("not a whole number", text, "long"))
    return F.coalesce(text.try_cast("long"), bad)


def required(value: Column, name: str, data_type) -> Column:
    """The value, or an error where it is missing."""
    return F.coalesce(value, F.raise_error(F.lit(f"record lacks {name}")).cast(data_type))


def kept_exactly(value: Column, source, target) -> Column:
    """A value of type ``source`` as ``target``; one that the cast would change raises."""
    if source == target:
        return value
    if source.typeName() == "string":
        if target == PRICE:
            return exact_decimal(value)
        return whole_number(value) if target.typeName() == "bigint" or target.typeName() == "long" else value.cast(target)
    cast = value.try_cast(target)
    same = cast.try_cast(source) == value if source.typeName() in ("float", "double") else cast == value
    bad = F.when(value.isNotNull(), _fail(f"does not fit {target.simpleString()}", value.cast("string"), target))
    return F.coalesce(F.when(same, cast), bad)


def to_units(price: Column) -> Column:
    """Price as a whole number of 1e-8 units, for operators that work on integers."""
    return (price * F.lit(UNIT)).cast("long")


def from_units(units: Column) -> Column:
    return (units.cast("decimal(18,0)") * F.expr("0.00000001BD")).cast(PRICE)
