"""Slugify (F10) and label clean-up."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def slugify(value: str | None) -> str:
    """Identifier-safe name: lower case, spaces/dashes -> ``_``, other
    characters dropped, ``_`` prepended when it starts with a digit.

    Used to name generated columns (pivot); names must exist before the plan.
    """
    if not value:
        return ""
    s = value.lower()
    s = re.sub(r"[ -]+", "_", s)
    s = re.sub(r"[^a-z0-9_]+", "", s)
    if s[:1].isdigit():
        s = "_" + s
    return s


def slugify_col(c) -> Column:
    """The same rule as a Column expression; NULL becomes ``''``."""
    s = F.lower(as_col(c))
    s = F.regexp_replace(s, r"[ -]+", "_")
    s = F.regexp_replace(s, r"[^a-z0-9_]+", "")
    s = F.regexp_replace(s, r"^([0-9])", "_$1")
    return F.coalesce(s, F.lit(""))


def strip_label(c, suffix: str) -> Column:
    """``REPLACE(UPPER(c), suffix, '')``."""
    return F.replace(F.upper(as_col(c)), F.lit(suffix), F.lit(""))
