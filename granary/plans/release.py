"""Release of aggregates: only declared kinds of numbers leave, and values only where each stands for k rows."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from ..operators.profile import safe_values


class Refused(Exception):
    pass


@dataclass(frozen=True)
class Policy:
    columns: frozenset[str]
    personal: frozenset[str] = frozenset()
    k: int = 5
    most_values: int = 50


#: What a field may be; a field without a kind is refused.
KINDS = {
    "count": lambda x: isinstance(x, int) and not isinstance(x, bool) and x >= 0,
    "rate": lambda x: isinstance(x, int | float) and not isinstance(x, bool) and math.isfinite(x) and 0 <= x <= 1,
    "identifier": lambda x: isinstance(x, str) and 0 < len(x) <= 128 and x.isascii() and all(c.isalnum() or c in "._-:" for c in x),
    "digest": lambda x: isinstance(x, str) and len(x) == 64 and set(x) <= set("0123456789abcdef"),
    # a shape: no letter but A, no digit but 9, so that no value is told
    "mask": lambda x: isinstance(x, str) and len(x) <= 128 and x.isascii() and all(c in "A9" or not c.isalnum() for c in x),
    "time": lambda x: isinstance(x, datetime) and x.tzinfo is not None,
}


def column_values(df: DataFrame, name: str, policy: Policy) -> list[tuple[str, int]]:
    """Values and rows, or Refused. The driver gets most_values rows at most."""
    if name not in policy.columns or name in policy.personal:
        raise Refused(f"column {name!r} may not leave")
    rows = safe_values(df, name, policy.k, policy.most_values).collect()
    if not rows:
        raise Refused(f"column {name!r}: too many values or a value of fewer than {policy.k} rows")
    return sorted((r["value"], r["rows"]) for r in rows)


def document(fields: dict[str, tuple[str, object]]) -> str:
    """Sorted ASCII JSON of name -> (kind, value)."""
    for name, (kind, value) in fields.items():
        if kind not in KINDS or not KINDS[kind](value):
            raise Refused(f"field {name!r} is no {kind}")
    plain = {k: v.isoformat() if isinstance(v, datetime) else v for k, (_, v) in fields.items()}
    return json.dumps(plain, sort_keys=True, indent=2, ensure_ascii=True) + "\n"
