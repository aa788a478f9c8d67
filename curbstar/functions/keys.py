"""Surrogate keys: MD5 of concatenated key parts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbstar.functions import values as V


def concat_parts(parts: Iterable[Column], sep: str = "") -> Column:
    """The parts as one text; null when any part is null."""
    texts: list[Column] = []
    for part in parts:
        if texts and sep:
            texts.append(F.lit(sep))
        texts.append(part.cast("string"))
    return F.concat(*texts)


def surrogate_key(parts: Iterable[Column], sep: str = "") -> Column:
    """MD5 in hex of the concatenated parts; null when any part is null.

    Without a separator 1, 23 and 12, 3 share a key. That is the published key and so the
    default; give ``sep`` where keys need not agree with it.
    """
    return F.md5(concat_parts(parts, sep))


def vehicle_key(plate_id: Column, state: Column, plate_type: Column, sep: str = "") -> Column:
    return surrogate_key([F.upper(plate_id), F.upper(state), F.upper(plate_type)], sep)


def location_key(row: dict[str, Column], sep: str = "") -> Column:
    """Key of a place; ``row`` gives the eight columns by their stage 2 names."""
    return surrogate_key(
        [
            row["street_code1"],
            row["street_code2"],
            row["street_code3"],
            F.upper(row["street_name"]),
            F.upper(row["intersecting_street"]),
            F.coalesce(row["violation_precinct"], F.lit(V.MISSING_PRECINCT)),
            F.upper(row["violation_county"]),
            F.upper(row["house_number"]),
        ],
        sep,
    )
