"""URL parsing by plain string functions.

These follow the reference's string rules, not RFC parsing, so that results
agree on malformed input too (``parse_url`` would return NULL there).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def _strip_scheme(url: Column, android: bool) -> Column:
    s = url
    if android:
        s = F.replace(s, F.lit("android-app://"), F.lit(""))
    s = F.replace(s, F.lit("http://"), F.lit(""))
    return F.replace(s, F.lit("https://"), F.lit(""))


def url_host(field) -> Column:
    """Scheme removed; text before the first ``/``, then before ``?``."""
    s = _strip_scheme(as_col(field), android=True)
    return F.split_part(F.split_part(s, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))


def url_path(field) -> Column:
    """Scheme removed; what lies between the first ``/`` and the next ``?``.

    Without a ``/`` there is no path, but a string that has no ``?`` either is
    returned whole.
    """
    s = _strip_scheme(as_col(field), android=False)
    slash, query = F.instr(s, "/"), F.instr(s, "?")
    return (F.when(slash > 0, F.substring_index(F.substr(s, slash + 1), "?", 1))
            .when(query > 0, F.lit("")).otherwise(s))


def url_parameter(field, name: str) -> Column:
    """Value after ``name=`` up to the next ``&``; empty becomes NULL."""
    after = F.split_part(as_col(field), F.lit(f"{name}="), F.lit(2))
    return F.nullif(F.split_part(after, F.lit("&"), F.lit(1)), F.lit(""))
