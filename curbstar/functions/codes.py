"""Codes and numbers: sentinels, ranges, small maps and defaults."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbstar.functions import values as V


def valid_model_year(year: Column, as_of_year: int) -> Column:
    """The model year when plausible in ``as_of_year``, else null.

    The year is an argument, so that a rerun gives the same result.
    """
    newest = as_of_year + V.MODEL_YEARS_AHEAD
    return F.when(year.between(V.OLDEST_MODEL_YEAR, newest), year)


def is_implausible_year(year: Column, as_of_year: int) -> Column:
    return ~year.between(V.OLDEST_MODEL_YEAR, as_of_year + V.MODEL_YEARS_AHEAD)


def fill_precinct(violation_precinct: Column, issuer_precinct: Column) -> Column:
    """The precinct, with 0 replaced by the issuer's, and null when both are 0.

    A null precinct stays null: only the zero placeholder asks for the issuer's.
    """
    return F.when(
        violation_precinct == V.ZERO_CODE, F.nullif(issuer_precinct, F.lit(V.ZERO_CODE))
    ).otherwise(violation_precinct)


def map_values(code: Column, mapping: Mapping[str, str]) -> Column:
    """The mapped value, matching case exactly; null for a code not in the mapping."""
    pairs = F.create_map(*[F.lit(item) for item in chain(*mapping.items())])
    return F.try_element_at(pairs, code)


def front_or_opposite(code: Column, literal: bool = False) -> Column:
    """Side of the street of a code in either case; null for other codes.

    ``literal=True`` keeps the older output, where only F means in front.
    """
    mapping = dict(V.FRONT_OR_OPPOSITE)
    if literal:
        mapping["I"] = mapping["O"]
    return map_values(F.upper(code), mapping)


def or_unknown(value: Column) -> Column:
    return F.coalesce(value, F.lit(V.UNKNOWN))
