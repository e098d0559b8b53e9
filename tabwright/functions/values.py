"""Missing tokens, numeric text and number formatting as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts a CSV reader treats as missing.
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Spellings that count as a number. Spark's own cast also takes '1d' and 'NaN'.
NUMBER_PATTERN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"
INTEGER_PATTERN = r"^\s*[+-]?\d{1,18}\s*$"
BOOLEAN_TEXTS = ["True", "TRUE", "true", "False", "FALSE", "false"]


def missing_to_null(c: Column) -> Column:
    """Text column with every missing token turned to null."""
    return F.when(~c.isin(NA_TOKENS), c)


def nan_to_null(c: Column) -> Column:
    """Float column with NaN turned to null."""
    return F.when(~F.isnan(c), c)


def is_number_text(c: Column) -> Column:
    return c.rlike(NUMBER_PATTERN)


def number_from_text(c: Column) -> Column:
    """Double value of a text that spells a number, null otherwise."""
    return F.when(is_number_text(c), c.try_cast("double"))


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind, not blanks only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def float_text(c: Column) -> Column:
    """Spell a double the way class labels are spelled: 12345678.0, 1e+16, 1e-05.

    Spark writes 1.2345678E7; the shortest digits are the same, so only the
    position of the point and the exponent are rewritten.
    """
    s = F.abs(c).cast("string")
    mantissa = F.substring_index(s, "E", 1)
    exponent = F.substring_index(s, "E", -1).try_cast("int")
    digits = F.regexp_replace(F.regexp_replace(mantissa, r"\.0$", ""), r"\.", "")
    whole = exponent + 1
    shifted = F.when(
        F.length(digits) <= whole, F.concat(F.rpad(digits, whole, "0"), F.lit(".0"))
    ).otherwise(F.concat(F.substr(digits, F.lit(1), whole), F.lit("."), F.substr(digits, whole + 1)))
    scientific = F.concat(
        F.regexp_replace(mantissa, r"\.0$", ""),
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.abs(exponent).cast("string"), 2, "0"),
    )
    unsigned = (
        F.when(~s.contains("E"), s)
        .when(exponent.between(0, 15), shifted)
        .when(exponent == -4, F.concat(F.lit("0.000"), digits))
        .otherwise(scientific)
    )
    special = F.when(F.isnan(c), "nan").when(F.abs(c) == float("inf"), "inf")
    sign = F.when((c < 0) | c.cast("string").startswith("-"), "-").otherwise("")
    return F.concat(sign, F.coalesce(special, unsigned))


def label_text(c: Column, type_name: str) -> Column:
    """Text form of a label; missing becomes the class ``nan``."""
    if type_name in ("float", "double"):
        text = float_text(c.cast("double"))
    elif type_name.startswith("decimal"):
        text = float_text(c.cast("double"))
    elif type_name == "boolean":
        text = F.when(c, "True").otherwise(F.when(~c, "False"))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit("nan"))
