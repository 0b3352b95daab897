"""Target schemas: what a table should hold, and how a source's columns are bound to it.

A schema says names, meanings (a label of what a value is, each known to be personal or not) and which fields are required, the key
and the instant of freshness. Binding renames, carries the meanings in the columns' metadata, and says what does not fit.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Meanings and whether values of them are personal.
MEANINGS = {
    "identifier": False,
    "person id": True,
    "name": True,
    "email": True,
    "phone": True,
    "address": True,
    "amount": False,
    "quantity": False,
    "code": False,
    "date": False,
    "instant": False,
    "text": False,
}


@dataclass(frozen=True)
class Field:
    name: str
    meaning: str
    required: bool = False

    def __post_init__(self):
        if self.meaning not in MEANINGS:
            raise ValueError(f"{self.name}: no meaning {self.meaning!r}")

    @property
    def personal(self) -> bool:
        return MEANINGS[self.meaning]


@dataclass(frozen=True)
class Schema:
    id: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    instant: str | None = None

    def __post_init__(self):
        names = [f.name for f in self.fields]
        if len(set(names)) < len(names):
            raise ValueError(f"{self.id}: a field is named twice")
        if not self.key or {*self.key, *([self.instant] if self.instant else [])} - set(names):
            raise ValueError(f"{self.id}: key and instant are fields of the schema")

    @classmethod
    def from_dict(cls, d: Mapping) -> Schema:
        if unknown := d.keys() - {"id", "fields", "key", "instant"}:
            raise ValueError(f"unknown entries {sorted(unknown)}")
        return cls(d["id"], tuple(Field(**f) for f in d["fields"]), tuple(d["key"]), d.get("instant"))


def load(paths: Iterable[str | Path]) -> dict[str, Schema]:
    """Schemas of JSON files by the id that each states. The same id twice is an error."""
    out: dict[str, Schema] = {}
    for p in paths:
        s = Schema.from_dict(json.loads(Path(p).read_text(encoding="utf-8")))
        if s.id in out:
            raise ValueError(f"schema {s.id!r} is stated twice")
        out[s.id] = s
    return out


class Unknown(LookupError):
    """No file states a schema of this id."""


class Ambiguous(LookupError):
    """Several files state a schema of this id."""


def resolve(paths: Iterable[str | Path], id: str) -> Schema:
    """The one schema that states this id, whatever its file is called. A file that is no schema is an error, asked for or not."""
    stated = [Schema.from_dict(json.loads(Path(p).read_text(encoding="utf-8"))) for p in paths]
    named = [s for s in stated if s.id == id]
    if not named:
        raise Unknown(f"{id!r} is not among {sorted({s.id for s in stated})}")
    if len(named) > 1:
        raise Ambiguous(f"{id!r} is stated {len(named)} times")
    return named[0]


@dataclass(frozen=True)
class Binding:
    schema: Schema
    columns: Mapping[str, str]  # source column -> field
    unknown_fields: tuple[str, ...]
    lacking_columns: tuple[str, ...]
    unmet: tuple[str, ...]  # key and required fields that nothing is bound to

    @property
    def fits(self) -> bool:
        return not (self.unknown_fields or self.lacking_columns or self.unmet)


def bind(df: DataFrame, schema: Schema, columns: Mapping[str, str]) -> Binding:
    """Never raises: all that does not fit is listed, sorted."""
    named, bound = {f.name for f in schema.fields}, set(columns.values())
    needed = {*schema.key, *(f.name for f in schema.fields if f.required)}
    listed = lambda x: tuple(sorted(x))
    return Binding(schema, dict(columns), listed(bound - named), listed(set(columns) - set(df.columns)), listed(needed - bound))


def apply(df: DataFrame, binding: Binding) -> DataFrame:
    """The bound columns under their fields' names, with meaning and personal in their metadata."""
    if not binding.fits:
        raise ValueError(f"{binding.schema.id}: {binding.unknown_fields} {binding.lacking_columns} {binding.unmet}")
    by_name = {f.name: f for f in binding.schema.fields}
    note = lambda f: {"meaning": f.meaning, "personal": f.personal}
    return df.select(*(F.col(c).alias(n, metadata=note(by_name[n])) for c, n in binding.columns.items()))


def personal_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if f.metadata.get("personal")]
