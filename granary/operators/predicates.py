"""A closed set of quality predicates, each built as one Catalyst expression.

Row predicates say true or false of every row, never null, whatever the input holds. Set predicates speak of a column or a
key as a whole; they count, and give the rows at fault. A rule names a predicate and its parameters; it carries no code.

Where a table's types are known, numbers are compared as numbers, so that the comparison reaches the Parquet scan; a text is
read as a number by a strict pattern.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.checksums import CHECKSUMS

Types = Mapping[str, str]

#: Named patterns of public standards; a rule states a name, never an expression of its own.
PATTERNS = {
    # XML Schema part 2, lexical space of integer
    "xsd_integer": "[+-]?[0-9]+",
    # XML Schema part 2, NMTOKEN, ASCII only
    "nmtoken": "[A-Za-z0-9._:-]+",
    # RFC 3339, full-date, months and days within their ranges
    "rfc3339_date": "[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])",
    # RFC 3339, date-time: seconds and offset are not optional
    "rfc3339_instant": "[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])[Tt]([01][0-9]|2[0-3]):[0-5][0-9]:([0-5][0-9]|60)([.][0-9]+)?([Zz]|[+-]([01][0-9]|2[0-3]):[0-5][0-9])",
    # HTML standard, valid e-mail address
    "html_email": "[a-zA-Z0-9.!#$%&'*+/=?^_`{|}~-]+@[a-zA-Z0-9]([a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?([.][a-zA-Z0-9]([a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?)*",
    # RFC 9562, text form
    "uuid": "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    # ITU-T E.164, international number
    "e164": "[+][1-9][0-9]{1,14}",
    # ISO 3166-1 alpha-2 and ISO 4217, by shape
    "country_code": "[A-Z]{2}",
    "currency_code": "[A-Z]{3}",
}
#: What becomes of a row in which something that a predicate needs is missing: it holds, it fails, or it is not judged.
MISSING = ("pass", "fail", "skip")
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


@dataclass(frozen=True)
class Predicate:
    """params: name -> type or types; closed: name -> the values that it may have; build, fails: the row predicate and its negation (where that
    is better stated on its own), from a table's types and the parameters; judged: which rows it speaks of (None: all); count, faults:
    of a set predicate."""

    name: str
    params: Mapping[str, type | tuple[type, ...]]
    build: Callable[..., Column] | None = None
    fails: Callable[..., Column] | None = None
    judged: Callable[..., Column | None] | None = None
    count: Callable[..., DataFrame] | None = None
    faults: Callable[..., DataFrame] | None = None
    closed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def check(self, given: Mapping[str, Any]) -> None:
        """Refuse missing, unknown, mistyped and unlisted parameters. A truth value is no number; a list of columns has columns."""
        if missing := self.params.keys() - given.keys():
            raise ValueError(f"{self.name}: missing {sorted(missing)}")
        if unknown := given.keys() - self.params.keys():
            raise ValueError(f"{self.name}: unknown {sorted(unknown)}")
        for k, kind in self.params.items():
            if not isinstance(given[k], kind) or (isinstance(given[k], bool) and kind is not bool):
                raise TypeError(f"{self.name}: {k} is {type(given[k]).__name__}")
        for k, values in self.closed.items():
            if given[k] not in values:
                raise ValueError(f"{self.name}: {k} is {given[k]!r}, not one of {list(values)}")
        if "columns" in given and (not given["columns"] or not all(isinstance(c, str) for c in given["columns"])):
            raise ValueError(f"{self.name}: columns names one column or more")


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def absent(c: Column, blank_is_missing: bool) -> Column:
    return _sure(c.isNull() | text.blank(c.cast("string"))) if blank_is_missing else c.isNull()


def is_number(types: Types, column: str) -> bool:
    return types.get(column, "").split("(")[0] in NUMERIC


def _finite(types: Types, column: str) -> Column:
    """A numeric column's values that are numbers."""
    c = F.col(column)
    if types[column] in ("float", "double"):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return c.isNotNull()


def _numeric(types: Types, column: str) -> Column:
    return _sure(_finite(types, column)) if is_number(types, column) else text.number(F.col(column)).isNotNull()


def _in_range(types: Types, column: str, least: float, most: float) -> Column:
    c = F.col(column)
    if is_number(types, column):
        return c.isNotNull() & (c >= least) & (c <= most)  # NaN is greater than any bound
    return _sure(text.number(c).between(float(least), float(most)))


def _out_of_range(types: Types, column: str, least: float, most: float) -> Column:
    c = F.col(column)
    if is_number(types, column):
        return c.isNull() | (c < least) | (c > most)
    return ~_in_range(types, column, least, most)


def _listed(types: Types, column: str, values: list) -> Column:
    kinds = {type(v) for v in values if v is not None}
    if len(kinds) > 1:
        raise TypeError("in_set: the values are of different types")
    return F.col(column).isin([v for v in values if v is not None])


def _in_set(types: Types, column: str, values: list) -> Column:
    return _sure(_listed(types, column, values)) | (F.col(column).isNull() if None in values else F.lit(False))


def _not_in_set(types: Types, column: str, values: list) -> Column:
    c, out = F.col(column), ~_listed(types, column, values)
    return c.isNotNull() & out if None in values else c.isNull() | out


def _pair(holds: Callable[[Column, Column], Column]):
    def build(types: Types, left: str, right: str, missing: str, blank_is_missing: bool) -> Column:
        a, b = F.col(left), F.col(right)
        gone = absent(a, blank_is_missing) | absent(b, blank_is_missing)
        return F.when(gone, missing != "fail").otherwise(_sure(holds(a, b)))

    return build


def _pair_judged(types: Types, left: str, right: str, missing: str, blank_is_missing: bool) -> Column | None:
    return None if missing != "skip" else ~(absent(F.col(left), blank_is_missing) | absent(F.col(right), blank_is_missing))


def _present(columns: list, blank_is_missing: bool) -> Column:
    return reduce(and_, (~absent(F.col(c), blank_is_missing) for c in columns))


def _count_keys(df: DataFrame, columns: list, missing: str, blank_is_missing: bool) -> DataFrame:
    """rows, evaluated, violations in one scan: counts by key, combined before the shuffle, are added up."""
    whole = _present(columns, blank_is_missing)
    keys = df.groupBy(*columns, whole.alias("__whole")).agg(F.count("*").alias("__n"))
    n, zero = F.col("__n"), F.lit(0)
    bad = F.when(F.col("__whole"), F.when(n > 1, n).otherwise(0)).otherwise(n if missing == "fail" else zero)
    judged = F.when(F.col("__whole"), n).otherwise(zero if missing == "skip" else n)
    return keys.agg(*(F.coalesce(F.sum(x), zero).alias(name) for x, name in ((n, "rows"), (judged, "evaluated"), (bad, "violations"))))


def _duplicates(df: DataFrame, columns: list, missing: str, blank_is_missing: bool) -> DataFrame:
    """Rows with a key that another row has too; rows with an absent part are at fault only if missing fails. Counts are
    combined before the shuffle and rejoined, so a key of very many rows is no group in memory."""
    whole = _present(columns, blank_is_missing)
    twice = df.where(whole).groupBy(*columns).agg(F.count("*").alias("__n")).where("__n > 1").drop("__n")
    out = df.join(twice, columns, "left_semi").select(*df.columns)
    return out.unionByName(df.where(~whole)) if missing == "fail" else out


def _count_distinct(df: DataFrame, column: str, most: int, blank_is_missing: bool) -> DataFrame:
    values = df.groupBy(F.when(~absent(F.col(column), blank_is_missing), F.col(column)).alias("v")).agg(F.count("*").alias("n"))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return values.agg(rows.alias("rows"), rows.alias("evaluated"), F.when(F.count("v") > most, rows).otherwise(0).alias("violations"))


def _beyond(df: DataFrame, column: str, most: int, blank_is_missing: bool) -> DataFrame:
    """All rows if the column has more than so many distinct values, else none."""
    over = _count_distinct(df, column, most, blank_is_missing).select((F.col("violations") > 0).alias("__over"))
    return df.crossJoin(F.broadcast(over)).where("__over").select(*df.columns)  # one row


_PAIR = {"left": str, "right": str, "missing": str, "blank_is_missing": bool}
_POLICY = {"missing": MISSING}
PREDICATES = {
    p.name: p
    for p in (
        Predicate(
            "is_missing",
            {"column": str, "blank_is_missing": bool},
            lambda types, column, blank_is_missing: absent(F.col(column), blank_is_missing),
        ),
        Predicate(
            "is_present",
            {"column": str, "blank_is_missing": bool},
            lambda types, column, blank_is_missing: ~absent(F.col(column), blank_is_missing),
            lambda types, column, blank_is_missing: absent(F.col(column), blank_is_missing),
        ),
        Predicate(
            "matches",
            {"column": str, "pattern": str},
            lambda types, column, pattern: _sure(text.whole(F.col(column), PATTERNS[pattern])),
            closed={"pattern": tuple(PATTERNS)},
        ),
        Predicate(
            "length_between",
            {"column": str, "least": int, "most": int},
            lambda types, column, least, most: _sure(F.length(column).between(least, most)),
        ),
        Predicate("in_set", {"column": str, "values": list}, _in_set, _not_in_set),
        Predicate("is_numeric", {"column": str}, _numeric),
        Predicate("in_range", {"column": str, "least": (int, float), "most": (int, float)}, _in_range, _out_of_range),
        Predicate(
            "has_checksum",
            {"column": str, "scheme": str},
            lambda types, column, scheme: _sure(CHECKSUMS[scheme](F.col(column))),
            closed={"scheme": tuple(CHECKSUMS)},
        ),
        Predicate("is_iso_date", {"column": str}, lambda types, column: text.iso_date(F.col(column)).isNotNull()),
        Predicate("not_after", _PAIR, _pair(lambda a, b: a <= b), judged=_pair_judged, closed=_POLICY),
        Predicate("equal", _PAIR, _pair(lambda a, b: a == b), judged=_pair_judged, closed=_POLICY),
        Predicate(
            "unique_key", {"columns": list, "missing": str, "blank_is_missing": bool}, count=_count_keys, faults=_duplicates, closed=_POLICY
        ),
        Predicate("distinct_at_most", {"column": str, "most": int, "blank_is_missing": bool}, count=_count_distinct, faults=_beyond),
    )
}


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False)) if len(conditions) != 1 else conditions[0]
