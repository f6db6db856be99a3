"""Text cleaning and number coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.schema import MISSING, NULL_TOKENS

# Portable number pattern: ASCII digits only.
NUMBER = "([0-9]+[.]?[0-9]*)"


def normalize_missing(value: Column) -> Column:
    """NULL for every spelling of a missing value."""
    return F.when(~value.isin(NULL_TOKENS), value)


def or_missing(value: Column) -> Column:
    return F.coalesce(value, F.lit(MISSING))


def clean_price(price: Column) -> Column:
    """Drop thousands separators; the currency sign stays."""
    return F.replace(price, F.lit(","), F.lit(""))


def clean_rating(rating: Column) -> Column:
    """The first number in the text, NULL without one."""
    return F.nullif(F.regexp_extract(rating, NUMBER, 1), F.lit(""))


def coerce_numeric(value: Column, default) -> Column:
    """Text to double; what is not a number becomes `default`.

    Spark casts `4.5d` and keeps `nan`; both count as not a number here.
    """
    text = value.cast("string")
    typed_suffix = F.lower(F.trim(text)).rlike("[0-9.][df]$")
    number = F.when(typed_suffix, None).otherwise(text.try_cast("double"))
    number = F.nanvl(number, F.lit(None).cast("double"))
    return F.coalesce(number, F.lit(default).cast("double"))


def finite_or_null(value: Column) -> Column:
    return F.when(F.abs(value) < float("inf"), value)


def coerce_count(value: Column, default: int) -> Column:
    """Text to a whole number, truncated toward zero; infinities become `default`."""
    number = finite_or_null(coerce_numeric(value, default))
    return F.coalesce(number.try_cast("bigint"), F.lit(default).cast("bigint"))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _numeric_entities(text: Column) -> Column:
    """`&#8377;` and `&#x20B9;` as the character; numbers of no character as U+FFFD."""
    def piece(p: Column, i: Column) -> Column:
        number = F.regexp_extract(p, "^([0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});", 1)
        code = F.when(F.lower(F.left(number, F.lit(1))) == "x", F.conv(F.substring(number, 2, 9), 16, 10)) \
            .otherwise(number).cast("int")
        sound = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(sound, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return F.when(i == 0, p).when(number == "", F.concat(F.lit("&#"), p)).otherwise(
            F.concat(char, F.substr(p, F.length(number) + 2)))

    return F.when(~F.contains(text, F.lit("&#")), text).otherwise(
        F.array_join(F.transform(F.split(text, "&#"), piece), ""))


def strip_tags(html: Column) -> Column:
    """Element text as a browser shows it: tags dropped, entities decoded, white space as single blanks."""
    text = _numeric_entities(F.regexp_replace(html, "<[^>]*>", ""))
    # The entities that mark-up itself needs; `&amp;` goes last.
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                         ("&nbsp;", " "), ("&amp;", "&")]:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, "[\\s\u00a0]+", " "))


def fixed_digits(value: Column, digits: int) -> Column:
    """A number as text with that many decimals, for display only."""
    return F.format_string(f"%.{digits}f", value.cast("double"))


def optional_link(url: Column, label: str = "View product") -> Column:
    """Markdown link, NULL without a URL."""
    return F.when(normalize_missing(url).isNotNull(), F.concat(F.lit(f"[{label}]("), url, F.lit(")")))
