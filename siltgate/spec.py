"""What a table is: its columns, its key, its parent and its cleaning steps.

The steps are an ordered list because the order decides results: a nameless first
row must not hide a named second one (presence before keep-first), while a first
row with a bad amount takes its key down with it (keep-first before validity).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column as SparkColumn
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from siltgate.functions import DATE_FORMATS, lower_trimmed, not_negative, title_case


@dataclass(frozen=True)
class Field:
    name: str
    raw: DataType
    clean: DataType
    required: bool = False


@dataclass(frozen=True)
class RequirePresent:
    """Drop rows where any of ``columns`` is NULL."""

    columns: tuple[str, ...]


@dataclass(frozen=True)
class KeepFirst:
    """Keep the earliest row of each key."""

    keys: tuple[str, ...]


@dataclass(frozen=True)
class RequireRule:
    """Drop rows where ``predicate`` is not true."""

    name: str
    predicate: Callable[[], SparkColumn]


@dataclass(frozen=True)
class ParseDate:
    column: str
    formats: tuple[str, ...] = DATE_FORMATS


@dataclass(frozen=True)
class Normalise:
    column: str
    using: Callable[[str], SparkColumn]


Step = RequirePresent | KeepFirst | RequireRule | ParseDate | Normalise


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    fields: tuple[Field, ...]
    key: str
    steps: tuple[Step, ...]
    foreign_key: ForeignKey | None = None

    @property
    def columns(self) -> list[str]:
        return [field.name for field in self.fields]

    @property
    def date_columns(self) -> list[str]:
        return [step.column for step in self.steps if isinstance(step, ParseDate)]

    def raw_schema(self) -> StructType:
        return StructType([StructField(f.name, f.raw, True) for f in self.fields])

    def clean_schema(self) -> StructType:
        return StructType([StructField(f.name, f.clean, not f.required) for f in self.fields])

    def with_steps(self, *steps: Step) -> TableSpec:
        return replace(self, steps=steps)


def retail_specs(
    key_type: DataType | None = None,
    money_type: DataType | None = None,
    finite_amounts: bool = False,
    require_keys: bool = False,
) -> dict[str, TableSpec]:
    """Specs of the customer, order and payment tables.

    ``key_type`` is INT unless a wider one is named (ids past two billion need
    ``LongType``); ``money_type`` is DOUBLE unless, say, ``DecimalType(18, 2)`` is
    named.  ``require_keys`` drops rows whose own key is NULL; otherwise they are
    one group of keep-first and leave one row.
    """
    ident = key_type or IntegerType()
    money = money_type or DoubleType()
    text, date = StringType(), DateType()
    takes_nan = finite_amounts and isinstance(money, DoubleType)

    def amount_rule() -> SparkColumn:
        return not_negative("amount", finite=takes_nan)

    def key_rule(key: str) -> tuple[Step, ...]:
        return (RequirePresent((key,)),) if require_keys else ()

    customers = TableSpec(
        name="customers",
        fields=(
            Field("customer_id", ident, ident, required=True),
            Field("name", text, text, required=True),
            Field("signup_date", text, date),
            Field("country", text, text),
        ),
        key="customer_id",
        steps=(
            *key_rule("customer_id"),
            RequirePresent(("name",)),
            KeepFirst(("customer_id",)),
            ParseDate("signup_date"),
            Normalise("country", title_case),
        ),
    )
    orders = TableSpec(
        name="orders",
        fields=(
            Field("order_id", ident, ident, required=True),
            Field("customer_id", ident, ident, required=True),
            Field("order_date", text, date),
            Field("amount", money, money, required=True),
            Field("status", text, text, required=True),
        ),
        key="order_id",
        steps=(
            *key_rule("order_id"),
            KeepFirst(("order_id",)),
            RequireRule("amount", amount_rule),
            ParseDate("order_date"),
            Normalise("status", lower_trimmed),
        ),
        foreign_key=ForeignKey("customer_id", "customers", "customer_id"),
    )
    payments = TableSpec(
        name="payments",
        fields=(
            Field("payment_id", ident, ident, required=True),
            Field("order_id", ident, ident, required=True),
            Field("payment_date", text, date),
            Field("payment_status", text, text, required=True),
        ),
        key="payment_id",
        steps=(
            *key_rule("payment_id"),
            KeepFirst(("payment_id",)),
            ParseDate("payment_date"),
            Normalise("payment_status", lower_trimmed),
        ),
        foreign_key=ForeignKey("order_id", "orders", "order_id"),
    )
    return {spec.name: spec for spec in (customers, orders, payments)}
