"""Keys and tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: file-name markers and the tag each yields, first match wins --
SOURCE_TAG_RULES = [
    ("OH_COMPLETE", "OH"),
    ("GA_COMPLETE", "GA"),
    ("FL_COMPLETE_PT1", "FL_PT1"),
    ("FL_COMPLETE_PT2", "FL_PT2"),
]
SOURCE_TAG_DEFAULT = "UNKNOWN"
# ---------------------------------------------------------------------------------


def combination_key(code: Column, location: Column) -> Column:
    """``{code}_{location}``; the state is not part of the key."""
    return F.concat(code.cast("string"), F.lit("_"), location.cast("string"))


def source_tag(name: Column, rules=None, default: str = SOURCE_TAG_DEFAULT) -> Column:
    """Tag of a source name: the first rule whose marker the name contains."""
    rules = SOURCE_TAG_RULES if rules is None else rules
    out = None
    for marker, tag in rules:
        out = (F.when(name.contains(marker), F.lit(tag)) if out is None
               else out.when(name.contains(marker), F.lit(tag)))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)
