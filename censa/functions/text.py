"""Text columns: padding, blanks, identifiers."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value.
MISSING_TEXTS = ["", "NaN", "None"]


def blank_to_null(c: Column) -> Column:
    """Trimmed text with blanks and missing-value words turned into null."""
    trimmed = F.trim(c)
    return F.when(~trimmed.isin(MISSING_TEXTS), trimmed)


def zero_fill(c: Column, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole (``lpad`` alone would cut it)."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def _plain_forms() -> dict[str, str]:
    """Latin letters, ligatures and fractions with the ASCII part of their compatibility form."""
    codes = [*range(0x80, 0x250), *range(0x1E00, 0x1F00), *range(0xFB00, 0xFB07)]
    forms = {chr(code): unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode() for code in codes}
    return {letter: plain for letter, plain in forms.items() if plain}


def strip_accents(c: Column) -> Column:
    """Replace accented Latin letters and drop whatever is still not ASCII."""
    forms = _plain_forms()
    single = {a: p for a, p in forms.items() if len(p) == 1}
    several = {a: p for a, p in forms.items() if len(p) > 1}
    # Ligatures and fractions are rare, so only texts that hold one are taken apart.
    known = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    letters = F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_element_at(known, x), x))
    spelled = F.when(c.rlike(f"[{''.join(several)}]"), F.array_join(letters, "")).otherwise(c)
    return F.regexp_replace(F.translate(spelled, "".join(single), "".join(single.values())), r"[^\x00-\x7F]", "")


def normalize_name(c: Column, per_character: bool = False) -> Column:
    """Identifier form of a name: lower case, no accents, ``_`` for anything else.

    A run of other characters becomes one ``_``, or one each with ``per_character``.
    """
    other = r"[^a-z0-9_]" if per_character else r"\W+"
    return F.btrim(F.regexp_replace(strip_accents(F.lower(c)), other, "_"), F.lit("_"))


def normalized(name: str, per_character: bool = False) -> str:
    """``normalize_name`` for a column or table name known on the driver."""
    plain = unicodedata.normalize("NFKD", name.lower()).encode("ascii", "ignore").decode()
    out: list[str] = []
    for ch in plain:
        if ch.isalnum() or ch == "_":
            out.append(ch)
        elif per_character or not out or out[-1] != "\0":
            out.append("\0")
    return "".join("_" if ch == "\0" else ch for ch in out).strip("_")


def only_digits(c: Column, width: int | None = None) -> Column:
    """Whether the whole text is digits, ``width`` of them if given."""
    return c.rlike(f"^[0-9]{{{width}}}$" if width else "^[0-9]+$")
