"""Text rules: case-blind search, cuts, canonical names, numbers held as text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def same_text(left: Column, right: Column | str) -> Column:
    """Equality that ignores case and trailing blanks."""
    right = F.lit(right) if isinstance(right, str) else right
    return F.rtrim(F.lower(left)) == F.rtrim(F.lower(right))


def contains_text(text: Column, marker: Column | str) -> Column:
    """Case-blind substring test; NULL text gives NULL, so a filter drops it either way."""
    marker = F.lit(marker.lower()) if isinstance(marker, str) else F.lower(marker)
    return F.contains(F.lower(text), marker)


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def one_of(value: Column, names: Iterable[str]) -> Column:
    """Case-blind membership in a short list; False for NULL."""
    lowered = [name.lower() for name in names]
    return F.coalesce(F.lower(value).isin(lowered), F.lit(False)) if lowered else F.lit(False)


def sub_id_root(partner: Column, sub_id: Column, cutting_partner: str) -> Column:
    """For one partner: the text before the first '-', else before the first '_', else all of it."""
    cutting = same_text(partner, cutting_partner)
    return (
        F.when(cutting & F.contains(sub_id, F.lit("-")), F.substring_index(sub_id, "-", 1))
        .when(cutting & F.contains(sub_id, F.lit("_")), F.substring_index(sub_id, "_", 1))
        .otherwise(sub_id)
    )


def months_on_job(text: Column) -> Column:
    """Months from the *positions* of Y and M in the text, as the source system derives them."""
    upper = F.upper(text)
    return (F.instr(upper, "Y") - 3) * 12 + (F.instr(upper, "M") - 3)


def months_on_job_from_digits(text: Column) -> Column:
    """Months from the numbers in front of Y and M ('2Y3M' -> 27)."""
    part = lambda unit: F.coalesce(F.regexp_extract(F.upper(text), rf"(\d+)\s*{unit}", 1).try_cast("int"), F.lit(0))
    return F.when(text.isNotNull(), part("Y") * 12 + part("M"))


def email_domain(text: Column) -> Column:
    """Text after the first '@', or all of it when there is none."""
    trimmed = F.rtrim(text)
    return F.substring(trimmed, F.instr(trimmed, "@") + 1, F.length(trimmed))


def canonical_name(text: Column, rules: Sequence[tuple[Sequence[str], str]]) -> Column:
    """Upper-cased text, replaced by the first rule with a fragment in it; NULL stays NULL."""
    upper = F.upper(text)
    hit = lambda fragments: reduce(lambda a, b: a | b, [F.contains(upper, F.lit(f)) for f in fragments])
    (fragments, name), *rest = rules
    chain = F.when(hit(fragments), F.lit(name))
    for fragments, name in rest:
        chain = chain.when(hit(fragments), F.lit(name))
    return chain.otherwise(upper)


def prefix_before_bracket(text: Column, width: int = 30) -> Column:
    """The first ``width`` characters, up to the first '[' or '%'."""
    return F.regexp_extract(F.substring(text, 1, width), r"^[^\[%]*", 0)


def is_number(value: Column) -> Column:
    """Whether the column's type is numeric: known when the plan is made, so it costs nothing per row."""
    return F.regexp_like(F.typeof(value), F.lit("^(tinyint|smallint|int|bigint|float|double|decimal.*)$"))


def percent_to_fraction(value: Column) -> Column:
    """'93%' -> 0.93; NULL when the rest is no number. A column that holds numbers is a fraction already."""
    text = F.regexp_replace(value.cast("string"), r"^%+|%+$", "").try_cast("double") / 100
    return F.when(is_number(value), value.try_cast("double")).otherwise(text)


def label_text(value: Column) -> Column:
    """A label as text: numbers of any type in one form ('1.0'), so that fitted labels meet the same values in another type."""
    return F.when(is_number(value), value.try_cast("double").cast("string")).otherwise(value.cast("string"))


def to_number(text: Column, divisor: float = 1.0) -> Column:
    return F.trim(text.cast("string")).try_cast("double") / divisor


def money(text: Column, precision: int = 18, scale: int = 2) -> Column:
    """Decimal from text with an optional '$'."""
    return F.trim(F.replace(text, F.lit("$"), F.lit(""))).try_cast(f"decimal({precision},{scale})")


def replace_in_set(value: Column, labels: Sequence[str], replacement: str) -> Column:
    return F.when(value.isin(list(labels)), F.lit(replacement)).otherwise(value)


def lookup_literal(key: Column, mapping: Mapping) -> Column:
    """Value of a small fixed mapping; NULL when the key is unknown."""
    entries = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.try_element_at(F.create_map(*entries), key) if entries else F.lit(None)


def read_quoted(text: Column) -> Column:
    """Rewrite the bare words None, True, False of a literal list to null, true, false."""
    for word, replacement in (("None", "null"), ("True", "true"), ("False", "false")):
        rewritten = F.regexp_replace(text, rf"([:\[,]\s*){word}(?=\s*[,\]}}])", f"$1{replacement}")
        text = F.when(F.contains(text, F.lit(word)), rewritten).otherwise(text)
    return text
