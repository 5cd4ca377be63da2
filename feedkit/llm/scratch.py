"""Tables that an operator writes on its way and deletes when its result is written."""

from __future__ import annotations

from feedkit.session import Scratch

__all__ = ["Scratch"]
