"""Recursive JSON work that SQL can't say: structural fingerprints, canonical JSON, wide exact decimals."""

from __future__ import annotations

import hashlib
import json
from decimal import Context, Decimal, Inexact, InvalidOperation

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shape(value: object) -> str:
    """The structure of a JSON value without its values.

    Objects keep sorted keys with their values' shapes, arrays keep the distinct shapes of their items, sorted,
    and numbers keep whether they are whole.
    """
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k)}:{shape(v)}" for k, v in sorted(value.items())) + "}"
    if isinstance(value, list):
        return "[" + ",".join(sorted({shape(v) for v in value})) + "]"
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, str):
        return "string"
    return "integer" if isinstance(value, int) else "number"


def _fingerprint(text: str | None) -> str | None:
    try:
        parsed = json.loads(text, parse_float=Decimal)
    except (TypeError, ValueError, RecursionError):
        return None
    return hashlib.sha256(shape(parsed).encode()).hexdigest()


@F.pandas_udf(T.StringType())
def structural_fingerprint(payload: pd.Series) -> pd.Series:
    """SHA-256 of a payload's shape; null for what is no JSON."""
    return payload.map(_fingerprint)


class _Number(str):
    """A number as it was written."""


def _no_number(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def _written(value: object) -> str:
    if isinstance(value, _Number):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_written(v)}" for k, v in sorted(value.items())) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_written, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


def _canonical(text: str | None) -> str | None:
    try:
        return _written(json.loads(text, parse_float=_Number, parse_int=_Number, parse_constant=_no_number))
    except (TypeError, ValueError, RecursionError):
        return None


@F.pandas_udf(T.StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """JSON with sorted keys, no spaces and numbers as they were written; null for what is no JSON."""
    return text.map(_canonical)


_WIDE = Context(prec=76, traps=[InvalidOperation])
_EXACT = Context(prec=38, traps=[InvalidOperation, Inexact])
_STEP = Decimal(1).scaleb(-18)


def _exact(operation: str, a: Decimal | None, b: Decimal | None) -> Decimal | None:
    if a is None or b is None or (operation == "divide" and b == 0):
        return None
    try:
        result = _WIDE.multiply(a, b) if operation == "multiply" else _WIDE.divide(a, b)
        narrow = result.quantize(_STEP, context=_EXACT)
    except (InvalidOperation, Inexact):
        return None
    back = narrow == result if operation == "multiply" else _WIDE.multiply(narrow, b) == a
    return narrow if back else None


@F.pandas_udf(T.DecimalType(38, 18))
def wide_multiply(a: pd.Series, b: pd.Series) -> pd.Series:
    """Product of decimal(38,18) columns; null where scale 18 or 38 digits can't hold it exactly."""
    return pd.Series([_exact("multiply", x, y) for x, y in zip(a, b, strict=True)], dtype=object)


@F.pandas_udf(T.DecimalType(38, 18))
def wide_divide(a: pd.Series, b: pd.Series) -> pd.Series:
    """Quotient of decimal(38,18) columns; null for a zero divisor or a remainder."""
    return pd.Series([_exact("divide", x, y) for x, y in zip(a, b, strict=True)], dtype=object)
