"""Table contracts and schema evolution: what a table may look like and how it may change."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns no published table may carry, the two lineage tables may, the
# text bodies an event table may not, and the stamp every published table gets.
QUEUE_FIELDS = ("submitted_at", "ingest_seq")
LINEAGE_FIELDS = ("source_run_id", "raw_loaded_at")
BODY_FIELDS = ("body", "content", "text")
LOADED_AT = "canonical_loaded_at"
FORMAL_FORBIDDEN = (
    "source source_name source_run_id source_status source_provider source_interface_id "
    "raw_loaded_at submitted_at ingest_seq provider provider_id provider_name ts_code index_code"
).split()


class ContractError(ValueError):
    """A table does not match its contract."""


def field_paths(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """(path, field name) of every field, nested structs and array elements included."""
    found = []
    for field in schema.fields:
        path = f"{prefix}{field.name}"
        found.append((path, field.name))
        inner, mark = field.dataType, ""
        while isinstance(inner, T.ArrayType):
            inner, mark = inner.elementType, mark + "[]"
        if isinstance(inner, T.StructType):
            found += field_paths(inner, f"{path}{mark}.")
    return found


def forbidden_fields(schema: T.StructType, lineage: bool = False, event: bool = False) -> list[str]:
    banned = set(QUEUE_FIELDS) | (set() if lineage else set(LINEAGE_FIELDS)) | (set(BODY_FIELDS) if event else set())
    return sorted(path for path, name in field_paths(schema) if name.lower() in banned)


def forbidden_formal_fields(schema: T.StructType) -> list[str]:
    """Paths that would reveal a source or provider to readers of a formal object."""
    listed = "|".join(FORMAL_FORBIDDEN)
    telling = re.compile(rf"(?:{listed})|(?:source|provider).*|.*_(?:source|provider).*", re.IGNORECASE | re.DOTALL)
    return sorted(path for path, name in field_paths(schema) if telling.fullmatch(name.strip()))


def schema_differences(actual: T.StructType, expected: T.StructType, nullability: bool = False) -> list[str]:
    """Missing, extra and differently typed columns, and order when the names agree."""
    have = {f.name: f for f in actual.fields}
    want = {f.name: f for f in expected.fields}
    notes = [f"missing column: {n}" for n in want if n not in have]
    notes += [f"unexpected column: {n}" for n in have if n not in want]
    for name in want.keys() & have.keys():
        if have[name].dataType != want[name].dataType:
            notes.append(f"type of {name}: {have[name].dataType.simpleString()} != {want[name].dataType.simpleString()}")
        elif nullability and have[name].nullable != want[name].nullable:
            notes.append(f"nullability of {name}")
    if not notes and list(have) != list(want):
        notes.append("column order differs")
    return sorted(notes)


def conformed(df: DataFrame, expected: T.StructType, table: str) -> DataFrame:
    """The expected columns of ``df`` in their order; a column that is absent or of another type is an error.

    Columns a table does not declare stay behind, and a column that happens never to be NULL becomes as nullable as
    declared.
    """
    names = set(expected.names)
    have = T.StructType([f for f in df.schema.fields if f.name in names])
    # Order and nullability are put right below; all else must agree.
    ordered = T.StructType(sorted(have.fields, key=lambda f: expected.names.index(f.name)))
    problems = schema_differences(ordered, expected)
    if problems:
        raise ContractError(f"{table}: " + "; ".join(problems))
    # nullif with NULL changes no value, but leaves a column that may be NULL as far as the plan knows.
    fixed = {f.name: F.nullif(F.col(f.name), F.lit(None).cast(f.dataType)) for f in ordered.fields if not f.nullable}
    return df.select(*[fixed.get(c, F.col(c)).alias(c) for c in expected.names])


def require_contract(
    schema: T.StructType, expected: T.StructType | None, table: str, lineage: bool = False
) -> None:
    problems = [f"forbidden field: {p}" for p in forbidden_fields(schema, lineage, event="event" in table)]
    if expected is not None:
        problems += schema_differences(schema, expected, nullability=True)
    if problems:
        raise ContractError(f"{table}: " + "; ".join(problems))


# --------------------------------------------------------------- evolution

#: A column before and after; the missing side of a new or removed column is None.
Pair = tuple[T.StructField | None, T.StructField | None]

# Types a value fits into without loss, and types a new column may have.
WIDER = {"int": "bigint", "float": "double"}
ADDABLE = (
    T.BooleanType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType, T.DateType,
    T.TimestampType, T.TimestampNTZType,
)


@dataclass(frozen=True)
class ColumnStep:
    """One permitted step; ``before`` is None for a new column."""

    kind: str
    column: str
    before: T.DataType | None
    after: T.DataType


@dataclass(frozen=True)
class Evolution:
    """Permitted steps, and the reasons for which the target cannot be reached by them."""

    changes: list[ColumnStep]
    rejections: list[str]

    @property
    def requires_backfill(self) -> bool:
        """A new column is NULL in older rows until it is filled."""
        return any(step.before is None for step in self.changes)


def _fits(old: T.StructField, new: T.StructField) -> bool:
    return old.dataType == new.dataType or WIDER.get(old.dataType.simpleString()) == new.dataType.simpleString()


# What is wrong with one pair: (applies to pairs with the sides "old", "new" or "both", test, reason).
FAULTS: list[tuple[str, Callable[[Pair], bool], str]] = [
    ("old", lambda pair: True, "{0} would be lost"),
    ("new", lambda pair: not pair[1].nullable, "{0} is new, so older rows hold no value and it must be nullable"),
    ("new", lambda pair: not isinstance(pair[1].dataType, ADDABLE), "{0} is new and of a type no table may gain"),
    ("both", lambda pair: pair[0].nullable != pair[1].nullable, "{0} must stay as nullable as it is"),
    ("both", lambda pair: not _fits(*pair), "{0} holds values that its new type may not"),
]


def plan_evolution(current: T.StructType, target: T.StructType) -> Evolution:
    """What leads from ``current`` to ``target``: new nullable columns behind the old ones, and wider numbers.

    The columns of both are laid side by side by name; each pair is held against FAULTS, and a pair
    without a fault that differs is a step.  Two rules regard the table as a whole: the old
    columns come first in their order, and nothing is lost where something is new (a rename).
    """
    before = {f.name: f for f in current}
    after = {f.name: f for f in target}
    steps, reasons = [], []
    for name in dict.fromkeys([*before, *after]):
        pair = before.get(name), after.get(name)
        side = "old" if pair[1] is None else "new" if pair[0] is None else "both"
        faults = [text.format(name) for where, wrong, text in FAULTS if where == side and wrong(pair)]
        reasons += faults
        if not faults and side == "new":
            steps.append(ColumnStep("add_column", name, None, pair[1].dataType))
        elif not faults and pair[0].dataType != pair[1].dataType:
            steps.append(ColumnStep("widen_type", name, pair[0].dataType, pair[1].dataType))
    if target.names[: len(before)] != current.names:
        reasons.append("the first columns must be the present ones in their order")
    lost, gained = before.keys() - after.keys(), after.keys() - before.keys()
    if lost and gained:
        reasons.append(f"a rename cannot be told from a loss: {sorted(lost)} and {sorted(gained)}")
    return Evolution(steps, reasons)
