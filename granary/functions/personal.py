"""Personal data in texts, by public formats: what is found is counted and can be masked; it is never shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.predicates import PATTERNS
from .checksums import iban, luhn

#: Where a candidate may stand: not inside a longer run of letters or digits.
_CANDIDATES = {
    "email": "(?<![a-zA-Z0-9])" + PATTERNS["html_email"],
    "card": "(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])",
    "iban": "(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![0-9A-Za-z])",
}
_CHECKS = {"card": luhn, "iban": iban}


def found(c: Column, kind: str) -> Column:
    """The values of a kind in a text: those of its format whose check digits are right."""
    all_ = F.regexp_extract_all(c, F.lit(_CANDIDATES[kind]), 0)
    return F.filter(all_, _CHECKS[kind]) if kind in _CHECKS else all_


def counts(c: Column) -> dict[str, Column]:
    """How many values of each kind a text holds (0 for a null)."""
    return {kind: F.coalesce(F.size(found(c, kind)), F.lit(0)).alias(kind) for kind in _CANDIDATES}
