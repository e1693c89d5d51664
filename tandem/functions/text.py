"""Cleaning of text, e-mail and phone values.

Each function uses its argument as few times as it can: Spark copies an argument that is itself an
expression to every place it is used.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: every character up to U+0020 is white space at the ends of a value.
EDGE_CHARS = "".join(chr(code) for code in range(0x21))


def _trimmed(value: Column) -> Column:
    return F.btrim(value, F.lit(EDGE_CHARS))


def clean_text(value: Column) -> Column:
    """Strip both ends; a blank value becomes null."""
    return F.nullif(_trimmed(value), F.lit(""))


def clean_email(value: Column) -> Column:
    """Lower-case address with ``_at_`` repaired; null unless it holds both ``@`` and a dot."""
    repaired = F.replace(F.lower(_trimmed(value)), F.lit("_at_"), F.lit("@"))
    return F.nullif(F.regexp_extract(repaired, r"(?s)^(?=.*@)(?=.*\.).*$", 0), F.lit(""))


def normal_phone(value: Column) -> Column:
    """French number printed in pairs, ``06 95 02 81 40``; null for anything else.

    A leading ``+33 (0)``, ``+33`` or ``0033`` stands for the 0 of the national form. Digits that are no such
    number leave all five groups of the pattern empty, so only the spaces between them remain.
    """
    national = F.regexp_replace(_trimmed(value), r"^(\+33\s*\(0\)|\+33|0033)", "0")
    digits = F.regexp_replace(national, r"[^0-9]", "")
    pairs = F.regexp_replace(digits, r"^(?:(0\d)(\d\d)(\d\d)(\d\d)(\d\d)|.*)$", "$1 $2 $3 $4 $5")
    return F.nullif(pairs, F.lit(" " * 4))


def plain_phone(value: Column) -> Column:
    """The same number as ten digits, ``0695028140``."""
    return F.replace(normal_phone(value), F.lit(" "), F.lit(""))


def stripped_phone(value: Column) -> Column:
    """A number without blanks, dots, dashes and French prefix; anything else in it stays, so none is lost."""
    national = F.regexp_replace(clean_text(value), r"^(\+33\s*\(0\)|\+33|0033)", "0")
    return F.regexp_replace(national, r"[\s.-]", "")


def prefixed(prefix: str, value: Column) -> Column:
    """Source prefix in front of an id; a null id stays null."""
    return F.concat(F.lit(prefix), value)


def label_null(value: Column, label: str) -> Column:
    """Readable label in place of null, for reports only."""
    return F.coalesce(value, F.lit(label))


def is_postcode(value: Column) -> Column:
    return F.translate(value, "123456789", "000000000") == "00000"
