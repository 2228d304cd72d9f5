"""Labels derived from names and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.text import as_col


def source_type(file_name: Column | str, profile: bool = False) -> Column:
    """Kind of source by words in the file name; the profiler has its own labels."""
    lowered = F.lower(as_col(file_name))
    result = F
    for words, label in fixed.PROFILE_SOURCE_TYPE_RULES if profile else fixed.SOURCE_TYPE_RULES:
        found = F.contains(lowered, F.lit(words[0]))
        for word in words[1:]:
            found = found | F.contains(lowered, F.lit(word))
        result = result.when(found, F.lit(label))
    return result.otherwise(F.lit(fixed.UNKNOWN_SOURCE_TYPE))


def instruction_for(kind: Column | str) -> Column:
    """Instruction wording for a source type, that of ``unknown`` for any other."""
    pairs = [F.lit(part) for pair in fixed.INSTRUCTION_BY_SOURCE_TYPE.items() for part in pair]
    return F.coalesce(
        F.element_at(F.create_map(*pairs), as_col(kind)),
        F.lit(fixed.INSTRUCTION_BY_SOURCE_TYPE[fixed.UNKNOWN_SOURCE_TYPE]),
    )


def is_error(text: Column | str) -> Column:
    """Failures travel in-band, as texts with a fixed prefix."""
    return F.coalesce(F.startswith(as_col(text), F.lit(fixed.ERROR_PREFIX)), F.lit(False))


def is_transient(message: Column | str) -> Column:
    """Whether an error message speaks of a failure worth a retry."""
    return F.rlike(F.lower(as_col(message)), F.lit("|".join(fixed.TRANSIENT_WORDS)))


def file_stem(file_name: Column | str) -> Column:
    """Name without its last suffix; a leading dot does not start a suffix."""
    return F.regexp_replace(as_col(file_name), r"(?<=.)\.[^.]+$", "")


def file_suffix(file_name: Column | str) -> Column:
    return F.lower(F.regexp_extract(as_col(file_name), r"(?<=.)(\.[^.]+)$", 1))
