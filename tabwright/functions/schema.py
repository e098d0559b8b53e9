"""Type classes that decide which profile rule a column takes."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = "text"
NUMBER = "number"
OTHER = "other"
UNSUPPORTED = "unsupported"
RESERVED = "_tabwright_"  # source columns may not begin so


def refuse_reserved(names) -> None:
    """Raise where a table has names that the plans need for themselves."""
    taken = [n for n in names if n.lower().startswith(RESERVED)]
    if taken:
        raise ValueError(f"column names beginning with {RESERVED} are reserved: {', '.join(taken)}")


def type_class(data_type: T.DataType) -> str:
    """text, number, other (counted as numerical) or unsupported."""
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return TEXT
    if isinstance(data_type, T.NumericType):
        return NUMBER
    if isinstance(data_type, (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return OTHER
    return UNSUPPORTED


def is_fractional(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.FloatType, T.DoubleType))


def is_integral(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.IntegralType)


def quoted(name: str) -> str:
    """Column reference safe for names holding dots or backticks."""
    return "`" + name.replace("`", "``") + "`"
