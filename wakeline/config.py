"""Configuration by named variables; a missing one is an error, never an empty text."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping


def fill(template: str, variables: Mapping[str, str] | None = None) -> str:
    """Replace every {NAME} in ``template``; names default to the environment's."""
    known = os.environ if variables is None else variables

    def value(m: re.Match) -> str:
        if m[1] not in known:
            raise ValueError(f"variable {m[1]} is not set")
        return known[m[1]]

    return re.sub(r"\{([A-Z][A-Z0-9_]*)\}", value, template)
