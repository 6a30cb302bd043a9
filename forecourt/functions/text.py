"""Column functions that turn listing text into typed values. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fuel words in the order they are looked for, and what is left over.
FUEL_WORDS = ("Petrol", "Diesel", "Hybrid", "Electric")
NO_FUEL_WORD = "Unknown"


def _without(text: Column, *marks: str) -> Column:
    for mark in marks:
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def null_to_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def _with_digit(text: Column) -> Column:
    """NULL for text without a digit: it is no whole number, and a cast that fails costs ten times one that does not."""
    return F.when(text.rlike(r"\p{Nd}"), text)


def whole_number(text: Column, type_name: str = "bigint") -> Column:
    """Text to integer, rounding a fraction half away from zero; NULL if it is no number.

    Plain digits, nearly all of the input, never reach the slower decimal cast.
    """
    text = _with_digit(text)
    return F.coalesce(text.try_cast(type_name), F.round(text.try_cast("decimal(38,6)")).try_cast(type_name))


def price_clean_ingest(price: Column) -> Column:
    """Text without the pound sign and thousands commas."""
    return _without(price, "£", ",")


def price_clean_try(price: Column) -> Column:
    """Whole price, NULL where the text is no price."""
    return whole_number(_without(price, "£", ","))


def price_clean_strict(price: Column) -> Column:
    """Price as double; only commas are removed, so other text fails the job (ANSI mode)."""
    return _without(price, ",").cast("double")


def brand_from_title(title: Column) -> Column:
    """Upper-case first word; empty for a title of one word."""
    return F.upper(
        F.when(F.instr(title, " ") > 0, F.substring_index(title, " ", 1)).when(
            title.isNotNull(), F.lit("")
        )
    )


def mileage_from_badges(badges: Column) -> Column:
    """Miles of the last MILEAGE badge that holds a number, else 0."""

    def miles(badge: Column) -> Column:
        text = F.coalesce(badge["displayText"], F.lit("0"))
        return _with_digit(F.substring_index(_without(text, ","), " ", 1)).try_cast("int")

    numbers = F.transform(F.filter(badges, lambda b: b["type"] == "MILEAGE"), miles)
    last = F.try_element_at(F.filter(numbers, lambda n: n.isNotNull()), F.lit(-1))
    return F.coalesce(last, F.lit(0))


def fuel_from_text(fuel_filter: Column, subtitle: Column, attention: Column) -> Column:
    """The request's fuel if it had one, else the first fuel word found in the text."""
    found = [
        F.when(null_to_empty(attention).contains(word) | null_to_empty(subtitle).contains(word), word)
        for word in FUEL_WORDS
    ]
    return F.coalesce(F.nullif(fuel_filter, F.lit("")), *found, F.lit(NO_FUEL_WORD))


def transmission_from_text(subtitle: Column, attention: Column) -> Column:
    automatic = null_to_empty(subtitle).contains("Auto") | null_to_empty(attention).contains("Auto")
    return F.when(automatic, "Automatic").otherwise("Manual")


def engine_size_regex(subtitle: Column) -> Column:
    """First digit.digit of the subtitle, else 0."""
    size = F.regexp_extract(null_to_empty(subtitle), r"(\d\.\d)", 1)
    return F.coalesce(F.nullif(size, F.lit("")).try_cast("double"), F.lit(0.0))


def pounds(amount: Column) -> Column:
    return F.concat(F.lit("£"), F.format_number(amount, 0))


def percent_text(value: Column) -> Column:
    return F.concat(F.format_number(value, 1), F.lit("%"))
