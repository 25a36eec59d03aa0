"""Connected components: those of the library."""

from __future__ import annotations

from weirgate.operators.components import components, extended

__all__ = ["components", "extended"]
