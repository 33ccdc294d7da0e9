"""Target column names, derived from source names when the plan is built."""

import re

_WORD_END = re.compile(r"([a-z0-9])([A-Z])")
_ACRONYM_END = re.compile(r"([A-Z]+)([A-Z][a-z])")


def upper_snake(name: str) -> str:
    """``ProcessBreakdownUp1Id`` -> ``PROCESS_BREAKDOWN_UP1_ID``.

    Names that start with an underscore are metadata and pass through unchanged.
    """
    if name.startswith("_"):
        return name
    return _ACRONYM_END.sub(r"\1_\2", _WORD_END.sub(r"\1_\2", name)).upper()
