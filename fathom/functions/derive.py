"""Expressions that turn base-table columns into domain attributes.

The domain tables (computers, fleet, cash points, flights) are projections of
the base tables; these helpers hold the per-row rules so the Spark views and
the SQL views stay in one place each.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The product family of each part type, and the translation of
# digits used to make letter-only model names.
PART_TYPE_FAMILY = {
    "ECONOMY": "PC",
    "SMALL": "PC",
    "MEDIUM": "Laptop",
    "PROMO": "Laptop",
}
OTHER_FAMILY = "Printer"
DIGITS = "0123456789"
DIGIT_LETTERS = "abcdefghij"
MISSING_PRICE = 950
MODELS_PER_MAKER_BLOCK = 80

# Ship class types (battleship, battlecruiser), CD drive
# speeds and the colour flag of printers, as the queries spell them.
BATTLESHIP = "bb"
BATTLECRUISER = "bc"
CD_SPEEDS = ("12x", "24x", "40x")
COLOUR_YES, COLOUR_NO = "y", "n"


def model_text(key: Column) -> Column:
    """Model number as text: mixed (``M123``), letters only, or digits only."""
    as_text = key.cast("string")
    return (
        F.when(key % 7 == 0, F.concat(F.lit("M"), as_text))
        .when(key % 5 == 0, F.translate(as_text, DIGITS, DIGIT_LETTERS))
        .otherwise(as_text)
    )


def money_price(retail: Column) -> Column:
    """Price rounded down to tens as decimal(18,2); one level becomes NULL."""
    price = (F.floor(retail / 10) * 10).cast("decimal(18,2)")
    return F.when(price == F.lit(MISSING_PRICE), F.lit(None).cast("decimal(18,2)")).otherwise(price)


def product_type(part_type: Column) -> Column:
    expr = None
    for source, family in PART_TYPE_FAMILY.items():
        cond = part_type == F.lit(source)
        expr = F.when(cond, F.lit(family)) if expr is None else expr.when(cond, F.lit(family))
    return expr.otherwise(F.lit(OTHER_FAMILY))


def family_filter(part_type: Column, family: str) -> Column:
    """Predicate on the raw part type selecting one product family.

    Written on the base column (``IN`` / ``NOT IN``) rather than on the
    derived ``type`` so the Parquet scan receives it as a pushed filter.
    """
    sources = [src for src, fam in PART_TYPE_FAMILY.items() if fam == family]
    if family == OTHER_FAMILY:
        return ~part_type.isin(*PART_TYPE_FAMILY) | part_type.isNull()
    return part_type.isin(*sources)


def maker_name(brand: Column, key: Column) -> Column:
    block = F.floor(key / MODELS_PER_MAKER_BLOCK).cast("int").cast("string")
    return F.concat(brand, F.lit("-"), block)


def nation_label(nation_key: Column) -> Column:
    return F.concat(F.lit("NATION_"), nation_key.cast("string"))


def ship_name(cust_key: Column, cust_name: Column, nation_key: Column) -> Column:
    """Lead ships carry their class name; every tenth customer gets 3 words."""
    return (
        F.when(cust_key < 25, nation_label(cust_key))
        .when(cust_key % 10 == 0, F.concat(cust_name, F.lit(" of "), nation_label(nation_key)))
        .otherwise(cust_name)
    )


# Battle results, in the order MIN picks them (text order:
# "OK" < "damaged" < "sunk").
RESULTS = ("OK", "damaged", "sunk")


def order_result_code(status: Column) -> Column:
    """Position of the result in ``RESULTS``: F -> sunk, P -> damaged, else OK.

    Aggregating the small integer (instead of the text) keeps MIN inside a
    hash aggregate; ``result_label`` turns it back into text.
    """
    return F.when(status == "F", F.lit(2)).when(status == "P", F.lit(1)).otherwise(F.lit(0))


def result_label(code: Column) -> Column:
    expr = F.when(code == 0, F.lit(RESULTS[0]))
    for i, label in enumerate(RESULTS[1:], start=1):
        expr = expr.when(code == i, F.lit(label))
    return expr


def null_if(value: Column, sentinel, dtype: str) -> Column:
    return F.when(value == F.lit(sentinel), F.lit(None).cast(dtype)).otherwise(value.cast(dtype))
