"""Dotted version numbers as arrays of parts."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def version_parts(version: Column) -> Column:
    """Numeric parts without trailing zeros; null when a part is not a number."""
    # Empty parts at the end do not count, so a text of dots alone has no parts.
    body = F.regexp_replace(version, r"\.+$", "")
    split = F.when((body == "") & (version != ""), F.array().cast("array<string>")).otherwise(
        F.split(body, "[.]")
    )
    parts = F.transform(
        split, lambda part: F.when(part.rlike(r"^[+-]?[0-9]+$"), part.try_cast("int"))
    )
    valid = F.forall(parts, lambda part: part.isNotNull())
    last = F.coalesce(
        F.array_max(F.transform(parts, lambda part, i: F.when(part != 0, i + 1))), F.lit(0)
    )
    return F.when(valid, F.slice(parts, F.lit(1), last))


def compare_parts(left: Column, right: Column) -> Column:
    """-1, 0 or 1; a missing part counts as 0."""
    signs = F.zip_with(
        left,
        right,
        lambda a, b: F.signum(
            F.coalesce(a, F.lit(0)).cast("long") - F.coalesce(b, F.lit(0)).cast("long")
        ).cast("int"),
    )
    decisive = F.filter(signs, lambda sign: sign != 0)
    both = left.isNotNull() & right.isNotNull()
    return F.when(both, F.when(F.size(decisive) > 0, decisive[0]).otherwise(0))
