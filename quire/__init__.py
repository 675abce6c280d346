"""quire: a PySpark-native analytics engine for paged documents."""

from __future__ import annotations

__version__ = "0.1.0"
