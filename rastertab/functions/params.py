"""Typed job parameters (SCL-15), read on the driver."""

from __future__ import annotations

from datetime import date, datetime

# The accepted words of a switch.
SWITCH_WORDS = {"true": True, "yes": True, "false": False, "no": False}


def _switch(text: str) -> bool:
    word = text.strip().lower()
    if word not in SWITCH_WORDS:
        raise ValueError(f"expected one of {sorted(SWITCH_WORDS)}, got {text!r}")
    return SWITCH_WORDS[word]


READERS = {bool: _switch, int: int, str: str, date: date.fromisoformat, datetime: datetime.fromisoformat}


def parameter(values: dict, name: str, kind: type, default=None):
    """``values[name]`` as ``kind`` (bool, int, str, date, datetime in ISO
    form).  Absent, null and blank values give ``default``; a value that
    already has the kind is returned as it is; anything else that cannot be
    read raises and names the parameter."""
    raw = values.get(name)
    if raw is None or (isinstance(raw, str) and not raw.strip()):
        return default
    if type(raw) is kind:
        return raw
    try:
        return READERS[kind](str(raw))
    except ValueError as exc:
        raise ValueError(f"parameter {name}: {exc}") from exc
