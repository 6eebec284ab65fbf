"""Quoted ``key=value`` text of a user profile into a map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlark.functions.text import bind

# Fixed value: the object name in front of the pairs.
PROFILE_OPENING = "UserJSONImpl{"

_BLANKS = "".join(chr(code) for code in range(33))


def profile_map(profile: Column) -> Column:
    """Map of the pairs, or null when one pair has no value.

    Commas inside single quotes do not separate. A value ends at its second ``=`` and loses its
    quotes. The last of several equal keys wins.
    """
    bare = F.replace(F.replace(profile, F.lit(PROFILE_OPENING), F.lit("")), F.lit("}"), F.lit(""))
    items = F.split(bare, r",(?=(?:[^']*+'[^']*+')*+[^']*+$)", -1)
    pairs = F.transform(
        items,
        lambda item: F.split(F.rtrim(F.btrim(item, F.lit(_BLANKS)), F.lit("=")), "=", -1),
    )
    return bind(pairs, _last_wins)


def _last_wins(pairs: Column) -> Column:
    entries = F.transform(
        pairs,
        lambda p: F.struct(
            F.get(p, F.lit(0)).alias("key"),
            F.replace(F.get(p, F.lit(1)), F.lit("'"), F.lit("")).alias("value"),
        ),
    )
    kept = bind(
        entries,
        lambda all_: F.filter(
            all_,
            lambda e, n: ~F.exists(
                F.slice(all_, n + 2, F.size(all_)), lambda later: later["key"] == e["key"]
            ),
        ),
    )
    return F.when(F.exists(pairs, lambda p: F.size(p) < 2), F.lit(None)).otherwise(
        F.map_from_entries(kept)
    )
