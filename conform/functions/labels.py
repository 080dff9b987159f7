"""Codes to labels, and the choice between two sources of the same label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the label every cleaned table carries where a code says nothing.
NOT_AVAILABLE = "n/a"


def map_codes(
    code: Column,
    labels: Mapping[str, Sequence[str]],
    *,
    default: str | None = NOT_AVAILABLE,
    blank: str | None = None,
    fold_case: bool = True,
) -> Column:
    """Label of a code, blanks around the code being ignored.

    ``labels`` lists the codes of each label. ``blank`` is the label of a NULL or empty code; without it
    such a code is treated like any unknown one. ``default`` is the label of unknown codes, or None to
    let them through as they are, trimmed.
    """
    trimmed = F.trim(code)
    compared = F.upper(trimmed) if fold_case else trimmed
    cases = [(compared.isin(*codes), F.lit(label)) for label, codes in labels.items()]
    if blank is not None:
        cases.append((trimmed.isNull() | (trimmed == ""), F.lit(blank)))
    otherwise = trimmed if default is None else F.lit(default)
    (first_test, first_label), *rest = cases
    return reduce(lambda chain, case: chain.when(*case), rest, F.when(first_test, first_label)).otherwise(otherwise)


def prefer(primary: Column, secondary: Column, sentinel: str = NOT_AVAILABLE) -> Column:
    """The primary label, or the secondary one where the primary is NULL or the sentinel."""
    return F.when(primary != sentinel, primary).otherwise(F.coalesce(secondary, F.lit(sentinel)))
