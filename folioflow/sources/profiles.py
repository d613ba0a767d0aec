"""Sources as data: a row of settings and, by name, a function that normalises its raw table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

Normaliser = Callable[[DataFrame], DataFrame]
_profiles: dict[str, tuple[dict, Normaliser | None]] = {}


def register_profile(name: str, row: dict | None = None, normaliser: Normaliser | None = None) -> None:
    """Adds or replaces a source: selectors, gates and provenance in ``row``."""
    _profiles[name] = (row or {}, normaliser)


def profile(name: str) -> dict:
    if name not in _profiles:
        raise KeyError(f"unknown source {name!r}; known: {', '.join(sorted(_profiles))}")
    return _profiles[name][0]


def names() -> list[str]:
    return sorted(_profiles)


def normalize(name: str, raw: DataFrame) -> DataFrame:
    profile(name)
    found = _profiles[name][1]
    return found(raw) if found else raw
