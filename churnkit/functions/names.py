"""Column-name rules (run on the driver, over names only)."""

from __future__ import annotations

import re

# A word is a run of capitals followed by its lower-case letters or digits.
_WORD = re.compile(r"[A-Z]*[a-z0-9]+|[A-Z]+")


def snake_case(name: str) -> str:
    """``Customer_ID`` -> ``customer_id``, ``_runTs`` -> ``run_ts``."""
    return "_".join(_WORD.findall(name)).lower()
