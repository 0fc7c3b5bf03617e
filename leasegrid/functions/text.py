"""Text parsing as column expressions (no Python UDFs)."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from leasegrid import constants as C

MINUS = "−"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """First regex group, NULL (not '') when there is no match."""
    return blank_to_null(F.regexp_extract(c, pattern, group))


def computed_once(c: Column, make: Callable[[Column], Column]) -> Column:
    """``make(c)`` with ``c`` evaluated once per row, however often ``make`` uses it.

    A column built from a column that is used k times is evaluated k times, and
    nested steps multiply: common subexpressions are not found beside lambdas.
    """
    return F.get(F.transform(F.array(c), make), F.lit(0))


def lookup(c: Column, mapping: Mapping[str, str]) -> Column:
    """Constant dictionary lookup; NULL for unknown keys."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), c)


# --- rents and features ------------------------------------------------------


def _compact_price(c: Column) -> Column:
    return F.replace(F.lower(F.regexp_replace(c, r"[$,]", "")), F.lit(" "), F.lit(""))


# Each keyword's weeks-per-payment divisor key; one lookup per extracted keyword.
_UNITS = {w: "weekly" for w in C.WEEKLY_WORDS} | {w: "monthly" for w in C.MONTHLY_WORDS}


def _known_frequency(text: Column) -> Column:
    words = "|".join(re.escape(w) for w in _UNITS)
    by_word = lookup(extract(text, rf"\d({words})"), _UNITS)
    return F.coalesce(by_word, F.when(text.rlike(r"^[\d.]+$"), F.lit("weekly")))


def rent_frequency(c: Column) -> Column:
    """'weekly' | 'monthly' | 'unknown' from the keyword that follows a number."""
    return F.coalesce(_known_frequency(_compact_price(c)), F.lit("unknown"))


def weekly_rent(c: Column, weeks_per_month: float = 4.0) -> Column:
    """Weekly rent of an advertised price text; NULL when the period is unknown."""
    text = _compact_price(c)
    value = extract(text, r"(\d+(?:\.\d+)?)").try_cast("double")
    weeks = F.create_map(F.lit("weekly"), F.lit(1.0), F.lit("monthly"), F.lit(float(weeks_per_month)))
    return value / F.try_element_at(weeks, _known_frequency(text))


def _feature_part(parts: Column, i: int) -> Column:
    return F.regexp_replace(F.trim(F.get(parts, F.lit(i))), ",+$", "")


def _has_unit(part: Column) -> Column:
    return part.rlike("ha|m²")


def _area(part: Column) -> Column:
    digits = F.trim(F.regexp_replace(part, "ha|m²|,", ""))
    hectares = (digits.try_cast("double") * 10000).cast("int")
    return F.when(F.contains(part, F.lit("ha")), hectares).when(
        F.contains(part, F.lit("m²")), digits.try_cast("int")
    )


def property_features(c: Column) -> Column:
    """Struct(bedrooms, bathrooms, car_spaces, land_area) of a ', ,'-separated card text."""
    parts = F.split(c, ", ,")
    first = _feature_part(parts, 0)
    land_first = F.when(_has_unit(first), _area(first))
    return F.struct(
        F.when(~_has_unit(first), first.try_cast("int")).alias("bedrooms"),
        _feature_part(parts, 1).try_cast("int").alias("bathrooms"),
        _feature_part(parts, 2).try_cast("int").alias("car_spaces"),
        F.coalesce(land_first, _area(_feature_part(parts, 3))).alias("land_area"),
    )


def card_features(c: Column) -> Column:
    """Comma-split variant: four raw strings, '' for blank or a minus sign."""
    parts = F.split(c, ",")

    def item(i: int) -> Column:
        value = F.coalesce(F.trim(F.get(parts, F.lit(i))), F.lit(""))
        return F.when(value == MINUS, "").otherwise(value)

    names = ["bedrooms", "bathrooms", "car_spaces", "land_area"]
    return F.struct(*[item(i).alias(n) for i, n in enumerate(names)])


def property_category(c: Column, strict_keys: bool = False) -> Column:
    """house | flat | unknown. ``strict_keys`` skips punctuation normalisation."""
    key = F.lower(c)
    if not strict_keys:
        key = F.trim(F.regexp_replace(key, r"\s*[/&]\s*", " "))
    return (
        F.when(key.isin(C.HOUSE_TYPES), "house").when(key.isin(C.FLAT_TYPES), "flat").otherwise("unknown")
    )


def common_type(c: Column, kept: Sequence[str] = tuple(C.COMMON_TYPES), other: str = "other") -> Column:
    """Collapse rare categories."""
    key = F.trim(F.lower(c))
    return F.when(key.isin(list(kept)), key).otherwise(other)


# --- addresses -----------------------------------------------------------------


def clean_street(c: Column) -> Column:
    """Last street number plus street name; unit/level style prefixes removed."""
    prefix = "|".join(C.STREET_PREFIXES)
    stripped = F.regexp_replace(
        F.trim(c), rf"(?i)^(?:(?:{prefix})(?=\s|$)\s*(?:\d+(?=\s|$)\s*)?)+", ""
    )

    def joined(words: Column, back: Column) -> Column:
        at = (F.size(words) - back + 1).cast("int")
        number, name = F.try_element_at(words, at), F.array_join(F.slice(words, at + 1, F.size(words)), " ")
        return computed_once(F.initcap(name), lambda n: F.when(n == "", number).otherwise(F.concat_ws(" ", number, n)))

    def from_words(words: Column) -> Column:
        has_digit = F.transform(words, lambda w: w.rlike(r"\d"))
        return computed_once(
            F.array_position(F.reverse(has_digit), F.lit(True)),
            lambda back: F.when(back == 0, F.initcap(F.array_join(words, " "))).otherwise(joined(words, back)),
        )

    return computed_once(
        stripped, lambda rest: F.when(rest == "", c).otherwise(computed_once(F.split(F.trim(rest), r"\s+"), from_words))
    )


def _slug_parts(c: Column) -> Column:
    return F.split(F.regexp_replace(c, "^/+", ""), "-")


def _slug_tail(parts: Column) -> Column:
    return F.concat(
        F.lit(", "),
        F.initcap(F.element_at(parts, -4)),
        F.lit(", "),
        F.upper(F.element_at(parts, -3)),
        F.lit(" "),
        F.element_at(parts, -2),
    )


def slug_address(c: Column) -> Column:
    """'/12-rose-lane-melbourne-vic-3000-99' -> '12 Rose Lane, Melbourne, VIC 3000'."""

    def address(parts: Column) -> Column:
        all_but_tail = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 4, F.lit(0)))
        street = computed_once(F.array_join(computed_once(all_but_tail, without_unit), " "), clean_street)
        return F.when(F.size(parts) >= 4, F.concat(street, _slug_tail(parts)))

    def without_unit(street: Column) -> Column:
        first_is_number = F.coalesce(F.get(street, F.lit(0)).rlike(r"^\d+$"), F.lit(False))
        return F.when(
            first_is_number, F.slice(street, F.lit(2), F.greatest(F.size(street) - 1, F.lit(0)))
        ).otherwise(street)

    return computed_once(_slug_parts(c), address)


def slug_address_with_unit(c: Column) -> Column:
    """Variant that keeps a leading unit number as 'unit/street-name, ...'."""

    def address(parts: Column) -> Column:
        all_but_tail = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 4, F.lit(0)))
        return F.when(F.size(parts) >= 4, F.concat(computed_once(all_but_tail, with_unit), _slug_tail(parts)))

    def with_unit(street: Column) -> Column:
        unit = F.get(street, F.lit(0))
        rest = F.array_join(F.slice(street, F.lit(2), F.greatest(F.size(street) - 1, F.lit(0))), "-")
        return F.when(
            F.coalesce(unit.rlike(r"^\d+$"), F.lit(False)), F.concat(unit, F.lit("/"), rest)
        ).otherwise(F.array_join(street, "-"))

    return computed_once(_slug_parts(c), address)


def slug(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(" "), F.lit("-"))


def rent_search_url(site: str, suburb: Column, postcode: Column, page: int | None = None) -> Column:
    """Search page of a suburb on a listing site (its address without a path)."""
    tail = F.lit("" if page is None else f"/?ssubs=0&page={page}")
    return F.concat(F.lit(f"{site}/rent/"), slug(suburb), F.lit("-vic-"), postcode.cast("string"), tail)


# --- names ----------------------------------------------------------------------


def normalise_name(c: Column) -> Column:
    """Lower-case, straight quotes, plain dashes, text before the first comma, single spaces."""
    folded = F.trim(F.translate(F.lower(c), "’–", "'-"))
    return F.coalesce(F.regexp_replace(F.substring_index(folded, ",", 1), r"\s+", " "), F.lit(""))


def strip_brackets(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"\s*\([^)]*\)", ""))


def repair_suburb(c: Column) -> Column:
    key = strip_brackets(c)
    return F.coalesce(lookup(key, C.SUBURB_REPAIRS), key)


def suburb_from_code(c: Column) -> Column:
    """'Carlton (SAL20495)' -> 'Carlton'; 'Unknown' otherwise."""
    return F.coalesce(F.trim(extract(c, r"(.+?)\s+\(SAL\d+\)")), F.lit("Unknown"))


def first_number_or_stem(name: Column) -> Column:
    return F.coalesce(extract(name, r"(\d+)"), F.replace(name, F.lit(".csv"), F.lit("")))


def is_age_summary(c: Column) -> Column:
    return F.coalesce(c.rlike("(?i)-|years|total"), F.lit(False))


def postcode_pairs(c: Column) -> Column:
    """Array of 'postcode<TAB>suburb' texts found line by line."""
    found = F.regexp_extract_all(c, F.lit(r"postcode:\s*(\d{4}\s*-\s*Suburb:\s*[^\n<]+)"), F.lit(1))
    return F.transform(
        found,
        lambda x: F.struct(
            F.regexp_extract(x, r"^(\d{4})", 1).alias("postcode"),
            F.trim(F.regexp_extract(x, r"Suburb:\s*(.+)", 1)).alias("suburb"),
        ),
    )


def tidy_text(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")), F.lit(""))


def join_texts(c: Column, sep: str = " ") -> Column:
    return F.trim(F.array_join(c, sep))
