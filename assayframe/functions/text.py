"""Text, notes, value maps and rounding."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fragments of upper-cased legal forms and their canonical spelling.
LEGAL_FORMS = (
    ("BESLOTEN VENNOOTSCHAP", "Besloten Vennootschap (BV)"),
    ("EENMANSZAAK", "Eenmanszaak"),
    ("VENNOOTSCHAP ONDER FIRMA", "Vennootschap onder firma (VOF)"),
    ("COMMANDITAIRE", "Commanditaire Vennootschap (CV)"),
    ("STICHTING", "Stichting"),
    ("VERENIGING", "Vereniging"),
    ("PUBLIEKRECHTELIJK", "Publiekrechtelijk"),
)


def canonical_by_fragment(col: Column, forms: Sequence[tuple[str, str]] = LEGAL_FORMS) -> Column:
    """The spelling of the first fragment found in the text, else the trimmed text."""
    trimmed = F.trim(col)
    folded = F.upper(trimmed)
    found = F.coalesce(*[F.when(folded.contains(part), F.lit(name)) for part, name in forms])
    return F.coalesce(found, trimmed)


def notes(conditions: Mapping[str, Column], separator: str = "; ") -> Column:
    """The names of the conditions that hold, joined; an empty text when none does."""
    return F.concat_ws(separator, *[F.when(test, F.lit(name)) for name, test in conditions.items()])


def join_present(separator: str, *cols: Column) -> Column:
    return F.concat_ws(separator, *cols)


def upper_or(col: Column, default: str) -> Column:
    return F.upper(F.coalesce(col, F.lit(default)))


def map_value(col: Column, mapping: Mapping, default) -> Column:
    """Look a value up in a small literal map."""
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), F.lit(default))


def spaced(col: Column) -> Column:
    return F.replace(col, F.lit("_"), F.lit(" "))


def round_half_even(col: Column, places: int) -> Column:
    return F.bround(col, places)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """``part`` in ``whole`` as a percentage, 0 when there is nothing to divide by."""
    scale = float(10**places)
    share = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * 100.0
    return F.coalesce(F.rint(share * scale) / scale, F.lit(0.0))
