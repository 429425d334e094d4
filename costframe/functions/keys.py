"""Record keys and text helpers used by the normalisers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text a missing dimension contributes to a hash key.
NULL_KEY_TEXT = "None"
# Fixed value: separator of the hashed key text.
KEY_SEPARATOR = "|"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def blank_to_null(col: Column | str) -> Column:
    """'' becomes NULL, everything else is kept."""
    return F.nullif(_c(col), F.lit(""))


def date_prefix(col: Column | str) -> Column:
    """First ten characters of an ISO date/time text as DATE."""
    return F.substring(_c(col), 1, 10).cast("date")


def dimension_key(day: Column | str, dims: Sequence[Column | str]) -> Column:
    """SHA-256 hex of ``day|dim1|dim2|...`` with missing dims written ``None`` (P10)."""
    parts = [_c(day).cast("string")] + [
        F.coalesce(_c(d).cast("string"), F.lit(NULL_KEY_TEXT)) for d in dims]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def first_present(cols: Sequence[Column | str]) -> Column:
    """First value that is neither NULL nor '' (P11, P13)."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def row_json(cols: Sequence[str]) -> Column:
    """The row as a JSON object text, NULL fields kept as ``null``."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]),
                     {"ignoreNullFields": "false"})


def row_hash(cols: Sequence[str]) -> Column:
    """SHA-256 of the row's JSON with keys in sorted order."""
    return F.sha2(row_json(sorted(cols)), 256)
