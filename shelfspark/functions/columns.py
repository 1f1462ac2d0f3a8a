"""Scalar column helpers shared by the SQL and the validated modes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: camelCase -> snake_case rule, "_" before every capital that is
# not the first character, then lower case (so "siteURL" -> "site_u_r_l").
_CAMEL_BOUNDARY = re.compile(r"(?<!^)(?=[A-Z])")


def snake_case(name: str) -> str:
    return _CAMEL_BOUNDARY.sub("_", name).lower()


def date_from_parts(parts: Column, strict: bool = True) -> Column:
    """Year/month/day struct -> DATE; NULL unless all three parts are present.

    ``strict`` keeps ANSI behaviour (an impossible date such as Feb 30 raises,
    as a cast would); otherwise impossible dates become NULL.
    """
    y, m, d = parts["year"], parts["month"], parts["day"]
    present = y.isNotNull() & m.isNotNull() & d.isNotNull()
    if strict:
        value = F.make_date(y.cast("int"), m.cast("int"), d.cast("int"))
    else:
        value = F.try_to_date(F.concat_ws("-", y, m, d), "y-M-d")
    return F.when(present, value)


def lockstep_unnest(arrays: dict[str, Column]) -> Column:
    """Unnest several arrays side by side (i-th elements together).

    Shorter arrays are padded with NULL; the row count is the longest array;
    NULL arrays count as empty, so a row whose arrays are all empty/NULL yields
    no rows. Use as ``df.select(..., lockstep_unnest({...}))`` (a generator).
    """
    # ``array()`` is array<void>; coalesce widens it to the other branch's type.
    zipped = F.arrays_zip(*[F.coalesce(c, F.array()).alias(n) for n, c in arrays.items()])
    return F.inline(zipped)
