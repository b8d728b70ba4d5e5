"""A contract: what one delivered entity looks like and what to do when it does not.

Contracts are plain Python values. They only hold declarations; the operators
turn them straight into Column expressions.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from stratagate import vocabulary as v
from stratagate.functions.convert import is_listed, label_of, to_date, to_number
from stratagate.functions.text import Transform

SPARK_TYPES = {
    v.TEXT: "string",
    v.INTEGER: "int",
    v.LONG: "bigint",
    v.DATE: "date",
}

DEFAULT_ACTIONS = {
    v.MALFORMED: v.QUARANTINE,
    v.NOT_NULL: v.QUARANTINE,
    v.CONVERSION: v.QUARANTINE,
    v.KEY_NULL: v.QUARANTINE,
    v.KEY_DUPLICATE: v.QUARANTINE_GROUP,
    v.DOMAIN: v.QUARANTINE,
}


@dataclass(frozen=True)
class Labels:
    """Literal domain: the accepted codes and, optionally, a label column."""

    codes: Mapping[str, str]
    label_column: str | None = None


@dataclass(frozen=True)
class Reference:
    """Domain kept in another published table; only diagnosed, never blocking."""

    identifier: str
    column: str


@dataclass(frozen=True)
class Field:
    name: str
    type: str = v.TEXT
    header: str | None = None
    aliases: tuple[str, ...] = ()
    absent: bool = False
    nullable: bool = True
    date_format: str | None = None
    precision: int | None = None
    scale: int | None = None
    decimal_mark: str = "."
    transforms: tuple[Transform, ...] = ()
    domain: Labels | Reference | None = None
    description: str = ""

    @property
    def spark_type(self) -> str:
        if self.type == v.DECIMAL:
            return f"decimal({self.precision},{self.scale})"
        return SPARK_TYPES[self.type]

    @property
    def labels(self) -> Labels | None:
        return self.domain if isinstance(self.domain, Labels) else None

    @property
    def reference(self) -> Reference | None:
        return self.domain if isinstance(self.domain, Reference) else None

    @property
    def label_column(self) -> str | None:
        return self.labels.label_column if self.labels else None

    @property
    def header_names(self) -> tuple[str, ...]:
        return (self.header or self.name, *self.aliases)

    def convert(self, text):
        """Typed value of the cleaned text Column."""
        if self.type == v.TEXT:
            return text
        if self.type == v.DATE:
            return to_date(text, self.date_format)
        return to_number(text, self.spark_type, self.decimal_mark)

    def label(self, code):
        return label_of(code, self.labels.codes, self.spark_type)

    def listed(self, code):
        """Whether a typed value is one of the declared codes."""
        return is_listed(code, self.labels.codes, self.spark_type)


@dataclass(frozen=True)
class Rule:
    """Spark SQL predicate over typed columns; only TRUE passes."""

    id: str
    expression: str
    columns: tuple[str, ...]
    action: str
    dimension: str


@dataclass(frozen=True)
class Dialect:
    separator: str = ";"
    quote: str = '"'
    escape: str = '"'
    encoding: str = "utf-8"
    header: bool = True
    tolerance: float = 0.0


@dataclass(frozen=True)
class Contract:
    source: str
    base: str
    entity: str
    fields: tuple[Field, ...]
    spec: str | None = None
    key: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    actions: Mapping[str, str] = field(default_factory=lambda: DEFAULT_ACTIONS)
    default_transforms: tuple[Transform, ...] = ()
    dialect: Dialect = Dialect()
    file_pattern: str = "*"
    part_count: int | None = None
    # a part delivered as a folder of files rather than as one file
    split_parts: bool = False
    # contract of the source's totals file, and its column with the rows of this entity
    declared_total: tuple[Contract, str] | None = None
    version: int = 1
    state: str = v.DRAFT
    read_hash: str = ""
    full_hash: str = ""
    description: str = ""

    def __post_init__(self):
        chosen = [(c, self.actions[c]) for c in v.DIMENSION]
        chosen += [(v.RULE, rule.action) for rule in self.rules]
        refused = [x for x in chosen if x[1] not in v.ALLOWED_ACTIONS[x[0]]]
        if refused:
            raise ValueError(f"action not allowed for its class: {refused}")

    @property
    def identifier(self) -> str:
        names = (self.source, self.base, self.entity, self.spec)
        return "_".join(n for n in names if n)

    @property
    def base_identifier(self) -> str:
        return f"{self.source}_{self.base}"

    @property
    def source_fields(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if not f.absent)

    @property
    def business_columns(self) -> list[str]:
        """Published columns in order: each label follows its code."""
        return [
            name
            for f in self.fields
            for name in (f.name, f.label_column)
            if name
        ]

    @property
    def expected_header(self) -> list[tuple[str, ...]]:
        return [f.header_names for f in self.source_fields]

    def must_not_be_null(self, f: Field) -> bool:
        """Key columns answer to the null-key check instead."""
        return not f.nullable and f.name not in self.key

    def bronze_schema(self) -> list[tuple[str, str]]:
        return [(f.name, "string") for f in self.fields] + [
            (name, "string") for name in v.LINEAGE
        ]

    def silver_schema(self) -> list[tuple[str, str]]:
        typed = {f.name: f.spark_type for f in self.fields}
        return [
            (name, typed.get(name, "string"))
            for name in (*self.business_columns, *v.LINEAGE)
        ]
