"""Reading the JSON payload of an event, through VARIANT.

Expressions that name a value more than once bind it with `let`; `with_facts` binds a whole payload.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Member that closes the envelope of `parse_payload`.
_END = "clicktide:end"
# --- fixed values: texts read as a number ------------------------------------------
PLAIN_NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INFINITE_NUMBER = "^[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it.

    A column that an expression names several times is copied into each place by the optimiser, and a
    parse with it. The variable of an array of one element is not.
    """
    return F.transform(F.array(value), body)[0]


def parse_payload(text: Column) -> Column:
    """VARIANT of a JSON text; null for missing, malformed or JSON-null text.

    The parser stops after the first document. The text is therefore parsed inside an envelope with a
    closing member, which text behind the document breaks or cuts off.
    """
    envelope = F.concat(F.lit('{"document":'), text, F.lit(f',"{_END}":0}}'))
    members = F.try_variant_get(F.try_parse_json(envelope), "$", "map<string,variant>")

    def document(members: Column) -> Column:
        whole = (F.size(members) == 2) & F.map_contains_key(members, _END)
        found = F.try_element_at(members, F.lit("document"))
        return F.when(whole & ~F.is_variant_null(found), found)

    return let(members, document)


def with_facts(
    rows: DataFrame, text: Column, facts: Callable[[Column], dict[str, Column]]
) -> DataFrame:
    """Rows with the columns that `facts` takes from their parsed payload.

    Each text is parsed once per scan. The facts leave a generator of one row, which is a boundary:
    the optimiser moves no filter on them below it and copies none of them into later steps.
    """
    named = let(
        parse_payload(text), lambda p: F.struct(*[c.alias(name) for name, c in facts(p).items()])
    )
    return rows.select("*", F.inline(F.array(named)))


def parse_failed(text: Column, payload: Column) -> Column:
    """True when a non-empty text yields no payload."""
    return F.coalesce((F.length(text) > 0) & payload.isNull(), F.lit(False))


def field(payload: Column, name: str, as_type: str) -> Column:
    """One top-level field, null when absent, JSON null or of another type."""
    return F.try_variant_get(payload, f"$.{name}", as_type)


def number(payload: Column, name: str) -> Column:
    """One top-level field as a double: JSON numbers, booleans as 0 and 1, and texts of a plain number.

    Blanks around the text are allowed. A text that names infinity is infinite; `NaN`, a number too
    large for a double and any other text are missing.
    """

    def of_text(text: Column) -> Column:
        endless = F.when(text.startswith("-"), float("-inf")).otherwise(float("inf"))
        finite = let(text.try_cast("double"), lambda v: F.when(F.abs(v) < float("inf"), v))
        return F.when(text.rlike(PLAIN_NUMBER), finite).when(text.rlike(INFINITE_NUMBER), endless)

    def of_value(value: Column) -> Column:
        text = F.regexp_replace(F.try_variant_get(value, "$", "string"), "^\\s+|\\s+$", "")
        return F.when(F.schema_of_variant(value) == "STRING", let(text, of_text)).otherwise(
            F.try_variant_get(value, "$", "double")
        )

    return let(F.try_variant_get(payload, f"$.{name}", "variant"), of_value)


def has_field(payload: Column, name: str) -> Column:
    """True when the field exists and is not JSON null."""
    value = F.try_variant_get(payload, f"$.{name}", "variant")
    return let(value, lambda v: v.isNotNull() & ~F.coalesce(F.is_variant_null(v), F.lit(True)))


def payload_hash(payload: Column) -> Column:
    """SHA-256 of the canonical (key-sorted, compact) JSON text; empty text when missing."""
    return F.sha2(F.coalesce(payload.cast("string"), F.lit("")), 256)


def items_json(payload: Column) -> Column:
    """Canonical JSON text of the item list, `null` when there is none."""
    items = F.try_variant_get(payload, "$.items", "variant")
    return F.coalesce(items.cast("string"), F.lit("null"))


def item_count(payload: Column) -> Column:
    """Length of the item list, null when the items are no list."""
    return F.array_size(field(payload, "items", "array<variant>"))


def invalid_purchase_check(transaction_id: Column, revenue: Column, has_items: Column, item_count: Column) -> Column:
    """Purchase defects counted by the quality check: an item value of any kind but `[]` passes."""
    return (
        transaction_id.isNull()
        | (F.coalesce(revenue, F.lit(-1.0)) <= 0)
        | ~has_items
        | F.coalesce(item_count == 0, F.lit(False))
    )


def invalid_purchase_clean(transaction_id: Column, revenue: Column, item_count: Column) -> Column:
    """Purchase defects the cleaner removes: also an empty id and items that are no list."""
    return (
        (F.coalesce(transaction_id, F.lit("")) == "")
        | (F.coalesce(revenue, F.lit(0.0)) <= 0)
        | (F.coalesce(item_count, F.lit(0)) == 0)
    )


def purchase_columns(payload: Column) -> dict[str, Column]:
    """Payload fields used by purchase rules, keyed by column name."""
    return {
        "transaction_id": field(payload, "transaction_id", "string"),
        "revenue": number(payload, "revenue"),
        "has_items": has_field(payload, "items"),
        "item_count": item_count(payload),
        "payload_hash": payload_hash(payload),
    }
