"""Rules over a table: summaries in one aggregation, the rows at fault, and repairs that can be undone.

A rule names a predicate; what it is about (its dimension and the meaning of its column), how grave a breach is and what repairs it are
stated beside. It is proposed first, then confirmed, enforced and in the end retired; only enforced rules divide a table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources.schema import MEANINGS
from .predicates import PREDICATES, Types, any_of

#: States and those that may follow.
STATES = {"proposed": ("confirmed", "retired"), "confirmed": ("enforced", "retired"), "enforced": ("retired",), "retired": ()}
SEVERITIES = ("info", "warning", "error")
DIMENSIONS = ("completeness", "validity", "consistency", "uniqueness", "timeliness")
#: Repairs of a text by name. What was there before is kept beside (see repair), so each can be undone.
REPAIRS: dict[str, Callable[[Column], Column]] = {
    "strip": text.strip,
    "collapse": text.collapse,
    "fold_case": text.fold_case,
    "digits_only": lambda c: F.regexp_replace(c, "[^0-9]", ""),
}


@dataclass(frozen=True)
class Rule:
    id: str
    predicate: str | None = None
    params: dict[str, Any] = field(default_factory=dict)
    state: str = "enforced"
    found_by: str | None = None  # what discovered it, if it was discovered
    confirmed_by: str | None = None
    severity: str = "error"
    dimension: str = "validity"
    meaning: str | None = None
    repair: str | None = None

    def __post_init__(self):
        for value, closed, what in ((self.state, STATES, "state"), (self.severity, SEVERITIES, "severity"), (self.dimension, DIMENSIONS, "dimension")):
            if value not in closed:
                raise ValueError(f"{self.id}: no {what} {value!r}")
        for value, closed, what in ((self.predicate, PREDICATES, "predicate"), (self.meaning, MEANINGS, "meaning"), (self.repair, REPAIRS, "repair")):
            if value is not None and value not in closed:
                raise ValueError(f"{self.id}: no {what} {value!r}")
        in_force = self.state in ("confirmed", "enforced")
        if self.predicate is None and (in_force or self.params or self.repair):
            raise ValueError(f"{self.id}: without a predicate a rule is only proposed, and has no parameters or repair")
        if self.found_by and in_force and not (self.confirmed_by or "").strip():
            raise ValueError(f"{self.id}: a discovered rule takes effect only when someone has confirmed it")
        if self.confirmed_by and not self.found_by:
            raise ValueError(f"{self.id}: only a discovered rule is confirmed by someone")
        if self.predicate:
            PREDICATES[self.predicate].check(self.params)
        if self.repair and not (self.by_row and "column" in self.params):
            raise ValueError(f"{self.id}: a repair needs a rule on one column's values")

    def to(self, state: str, by: str | None = None) -> Rule:
        """The rule in its next state."""
        if state not in STATES[self.state]:
            raise ValueError(f"{self.id}: {self.state} is not followed by {state}")
        return replace(self, state=state, confirmed_by=by or self.confirmed_by)

    @property
    def by_row(self) -> bool:
        return self.predicate is not None and PREDICATES[self.predicate].build is not None

    def holds(self, types: Types | None = None) -> Column:
        return PREDICATES[self.predicate].build(types or {}, **self.params)

    def fails(self, types: Types | None = None) -> Column:
        p = PREDICATES[self.predicate]
        return p.fails(types or {}, **self.params) if p.fails else ~self.holds(types)

    def judged(self, types: Types | None = None) -> Column | None:
        """Which rows the rule speaks of; None: of all."""
        p = PREDICATES[self.predicate]
        return p.judged(types or {}, **self.params) if p.judged else None

    def faults(self, df: DataFrame) -> DataFrame:
        """The rows at fault, with the table's columns."""
        return df.where(self.fails(dict(df.dtypes))) if self.by_row else PREDICATES[self.predicate].faults(df, **self.params)


def unbound(rules: Iterable[Rule]) -> list[str]:
    """Ids of rules in use that name no predicate or no meaning."""
    return sorted(r.id for r in rules if r.state != "retired" and (r.predicate is None or r.meaning is None))


def band(rate: Column) -> Column:
    """How much a rule's hold rate says: it always holds, nearly always, often, or hardly."""
    return F.when(rate >= 1, "always").when(rate >= 0.99, "nearly always").when(rate >= 0.9, "often").otherwise("hardly")


def counted(rules: Sequence[Rule], types: Types) -> tuple[list[Column], Column]:
    """Aggregates of the row rules, and from them the rows (rule_id, evaluated, skipped, violations)."""
    sums, rows = [F.count("*").alias("n")], []
    for k, r in enumerate(rules):
        judged = r.judged(types)
        sums.append(F.count_if(r.fails(types)).alias(f"v{k}"))
        evaluated = F.col("n")
        if judged is not None:
            sums.append(F.count_if(judged).alias(f"e{k}"))
            evaluated = F.col(f"e{k}")
        skipped = (F.col("n") - evaluated).alias("skipped")
        rows.append(F.struct(F.lit(r.id).alias("rule_id"), evaluated.alias("evaluated"), skipped, F.col(f"v{k}").alias("violations")))
    return sums, F.inline(F.array(*rows))


def summarise(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule_id, evaluated, skipped, violations, hold_rate (of the rows evaluated), band. All row rules share one scan and one aggregation;
    each set rule adds one scan and a grouped count of its own."""
    parts = []
    if by_row := [r for r in rules if r.by_row]:
        sums, rows = counted(by_row, dict(df.dtypes))
        parts.append(df.agg(*sums).select(rows))
    for r in rules:
        if not r.by_row:
            counts = PREDICATES[r.predicate].count(df, **r.params)
            parts.append(counts.select(F.lit(r.id).alias("rule_id"), "evaluated", (F.col("rows") - F.col("evaluated")).alias("skipped"), "violations"))
    out = reduce(DataFrame.unionByName, parts)
    rate = F.when(F.col("evaluated") > 0, 1 - F.col("violations") / F.col("evaluated"))
    return out.withColumn("hold_rate", rate).withColumn("band", band(F.col("hold_rate")))


def _live(rules: Sequence[Rule]) -> list[Rule]:
    return [r for r in rules if r.by_row and r.state == "enforced" and r.severity == "error"]


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that hold all enforced row rules of severity error, and the rest with the ids of those they break (broken_rules). Which rows are at
    fault is asked in a form that reaches the scan; the ids are made for those rows only."""
    live, types = _live(rules), dict(df.dtypes)
    if not live:
        return df, df.where(F.lit(False)).withColumn("broken_rules", F.array().cast("array<string>"))
    bad = any_of([r.fails(types) for r in live])
    broken = F.array_compact(F.array(*(F.when(r.fails(types), r.id) for r in live)))
    return df.where(~bad), df.where(bad).withColumn("broken_rules", broken)


NOTES = "repairs"


def repair(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Where an enforced rule with a repair fails, its column is repaired. What was there before is kept in the column repairs (an array of
    rule_id, column, before; in order), from which undo restores the table."""
    if NOTES in df.columns:
        raise ValueError(f"the table has a column {NOTES}")
    out = df.withColumn(NOTES, F.array().cast("array<struct<rule_id:string,column:string,before:string>>"))
    for r in rules:
        if r.repair and r.state == "enforced":
            name = r.params["column"]
            if dict(df.dtypes)[name] != "string":
                raise TypeError(f"{r.id}: {name} is no text")
            new = REPAIRS[r.repair](F.col(name))
            wrong = F.col(name).isNotNull() & r.fails(dict(df.dtypes)) & (new != F.col(name))
            note = F.array(F.struct(F.lit(r.id).alias("rule_id"), F.lit(name).alias("column"), F.col(name).alias("before")))
            out = out.withColumns({name: F.when(wrong, new).otherwise(F.col(name)), NOTES: F.when(wrong, F.concat(NOTES, note)).otherwise(F.col(NOTES))})
    return out


def undo(df: DataFrame) -> DataFrame:
    """A repaired table as it was: of each column the first note has what was there."""
    texts = [c for c, t in df.dtypes if t == "string"]
    first = lambda c: F.try_element_at(F.filter(NOTES, lambda x: x["column"] == c), F.lit(1))
    return df.withColumns({c: F.when(first(c).isNotNull(), first(c)["before"]).otherwise(F.col(c)) for c in texts}).drop(NOTES)
