"""Static ``key=value`` label lists, on the driver and as a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def labels_from_text(text: str) -> dict[str, str]:
    """Configured labels: ``k=v,k2=v2``; the first ``=`` splits, blanks are trimmed."""
    pairs = (part.partition("=") for part in text.split(","))
    return {key.strip(): value.strip() for key, eq, value in pairs if eq and key.strip()}


def _trim(col: Column) -> Column:
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def parse_labels(col: Column) -> Column:
    """The same rule for a text column, as ``map<string,string>`` (last key wins)."""
    pairs = F.filter(
        F.split(col, ",", -1), lambda p: F.contains(p, F.lit("=")) & (_trim(F.split_part(p, F.lit("="), F.lit(1))) != "")
    )
    return F.map_from_entries(
        F.transform(
            pairs,
            lambda p: F.struct(
                _trim(F.split_part(p, F.lit("="), F.lit(1))).alias("key"),
                _trim(F.substr(p, F.instr(p, "=") + 1)).alias("value"),
            ),
        )
    )
