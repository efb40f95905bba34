"""Expected result of every report as SQL over the source tables."""

from __future__ import annotations

from . import fact_side, frame_side, raw_side  # noqa: F401
from .base import PARTS, statement


def statements() -> dict[str, str]:
    return {key: statement(key) for key in PARTS}
