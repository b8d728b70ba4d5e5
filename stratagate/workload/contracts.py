"""Contracts over the derived inputs of the registered queries."""

from __future__ import annotations

from dataclasses import replace

from stratagate import vocabulary as v
from stratagate.contract import (
    DEFAULT_ACTIONS,
    Contract,
    Dialect,
    Field,
    Labels,
    Reference,
    Rule,
)
from stratagate.functions.text import empty_to_null, null_if, trim_ends, upper_case

STATUS = {"F": "Filled", "O": "Open", "P": "Partial"}

ORDERS = Contract(
    "shop",
    "sales",
    "orders",
    fields=(
        Field("order_id", v.LONG),
        Field("cust_id", v.LONG),
        Field(
            "status",
            transforms=(upper_case,),
            domain=Labels(STATUS, "status_label"),
        ),
        Field("amount", v.DECIMAL, precision=15, scale=2, decimal_mark=","),
        Field(
            "order_date",
            v.DATE,
            nullable=False,
            date_format="AAAAMMDD",
            transforms=(null_if("0", "00000000"),),
        ),
        Field("priority"),
    ),
    key=("order_id",),
    rules=(
        Rule(
            "amount_not_negative",
            "amount IS NULL OR amount >= 0",
            ("amount",),
            v.ALERT,
            "Accuracy",
        ),
    ),
    actions={**DEFAULT_ACTIONS, v.DOMAIN: v.QUARANTINE_AND_ALERT},
    default_transforms=(trim_ends, empty_to_null),
)

# the same, but a value that does not convert stops the publication
STRICT_ORDERS = replace(
    ORDERS, entity="strict_orders", actions={**ORDERS.actions, v.CONVERSION: v.BLOCK}
)

# orders as six delivered fields, without header, one folder per part
DELIVERED = replace(
    ORDERS,
    entity="delivered_orders",
    fields=(*ORDERS.fields[:-1], Field("note"), Field("legacy_code", absent=True)),
    dialect=Dialect(header=False, tolerance=0.05),
    split_parts=True,
)

# one line per shipped item, few columns: most rows are copies of each other
SHIPMENTS = Contract(
    "shop",
    "sales",
    "shipments",
    fields=(
        Field("flag", domain=Labels({"A": "Accepted", "R": "Returned"})),
        Field("line_status", domain=Labels({"F": "Final", "O": "Open"})),
        Field("line_number", v.INTEGER),
    ),
)

ITEMS = Contract(
    "shop",
    "sales",
    "items",
    fields=(
        Field("order_id", v.LONG),
        Field("line_number", v.INTEGER),
        Field("part_id", v.LONG, nullable=False),
        Field("quantity", v.DECIMAL, precision=15, scale=2),
        Field("price", v.DECIMAL, precision=15, scale=2, nullable=False),
        Field("flag", domain=Labels({"A": "Accepted", "N": "New", "R": "Returned"}, "flag_label")),
        Field("ship_date", v.DATE, date_format="AAAA-MM-DD", nullable=False),
    ),
    key=("order_id", "line_number"),
    rules=(
        Rule("some_quantity", "quantity > 0", ("quantity",), v.QUARANTINE, "Accuracy"),
        Rule(
            "price_covers_quantity",
            "price IS NULL OR quantity IS NULL OR price >= quantity",
            ("price", "quantity"),
            v.ALERT,
            "Accuracy",
        ),
    ),
    default_transforms=(trim_ends, empty_to_null),
)

CUSTOMERS = Contract(
    "shop",
    "sales",
    "customers",
    fields=(
        Field("c_custkey", v.LONG),
        Field("c_nationkey", v.INTEGER, domain=Reference("shop_sales_nations", "n_nationkey")),
        Field("c_mktsegment", domain=Reference("shop_sales_brands", "p_brand")),
        Field("c_name", domain=Reference("shop_sales_names", "name")),
    ),
)
