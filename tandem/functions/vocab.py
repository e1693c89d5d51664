"""Translation of status and channel words."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tandem import catalog
from tandem.functions.text import clean_text


def translate_words(value: Column, words: Mapping[str, str], unknown: str = "asis") -> Column:
    """Replace the words listed; ``unknown`` says how to match and what any other word becomes.

    - ``asis``: exact match, other words unchanged
    - ``trimmed``: match in any case after trimming, other words trimmed, blank becomes null
    - ``upper``: match in any case after trimming, other words in upper case
    """
    if unknown == "asis":
        probe, rest = value, value
    elif unknown == "trimmed":
        rest = clean_text(value)
        probe = F.upper(rest)
        # A word already in the target vocabulary is written in its normal form.
        words = {**words, **{word: word for word in words.values()}}
    elif unknown == "upper":
        probe = rest = F.upper(clean_text(value))
    else:
        raise ValueError(f"unknown mode: {unknown}")
    table = F.create_map(*(F.lit(word) for pair in words.items() for word in pair))
    return F.coalesce(F.element_at(table, probe), rest)


def translate_statuses(
    df: DataFrame,
    vocabulary: Mapping[str, Mapping[str, str]] = catalog.STATUS_WORDS,
    unknown: str = "asis",
) -> DataFrame:
    """Translate every vocabulary column the table has; other columns and tables pass through."""
    return df.select(
        *(
            translate_words(F.col(c), vocabulary[c], unknown).alias(c) if c in vocabulary else F.col(c)
            for c in df.columns
        )
    )


def translate_channels(df: DataFrame, column: str = "mode_paiement") -> DataFrame:
    return translate_statuses(df, {column: catalog.CHANNEL_WORDS})
