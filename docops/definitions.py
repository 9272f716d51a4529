"""Index definitions: names, switches and policies of one index."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from docops.functions.mapping import field_names
from docops.functions.names import DATE_SUFFIX, NAME_PATTERN
from docops.operators.retention import DELTA, MIN_TO_KEEP, Retention

# Parts of a date suffix, and the setting behind each switch.
DATE_PARTS = {"yyyy": "%Y", "MM": "%m", "dd": "%d", "HH": "%H", "mm": "%M", "ss": "%S"}
SETTING = {
    "name": "name",
    "mapping": "mapping",
    "enabled": "enabled",
    "compaction": "forcemerge",
    "shift": "shift",
    "date_suffix": "dateTimeFormat",
    "pattern": "dateTimePattern",
    "prune": "prune",
    "min_to_keep": "retention.mintokeep",
    "delta": "retention.delta",
    "close_shifted": "closeShifted",
}


def format_date(moment: datetime, pattern: str) -> str:
    """The date under a suffix pattern such as ``yyyyMMdd``, the same as routing writes it."""
    parts = re.split(f"({'|'.join(DATE_PARTS)})", pattern)
    if any(part not in DATE_PARTS and re.search("[A-Za-z]", part) for part in parts):
        raise ValueError(f"unsupported date suffix: {pattern}")
    return "".join(moment.strftime(DATE_PARTS[part]) if part in DATE_PARTS else part for part in parts)


@dataclass(frozen=True)
class IndexDefinition:
    """``index`` is the base name and alias; ``full_name`` the dated index behind it."""

    index: str | None
    full_name: str
    mapping: str | dict | None = None
    enabled: bool = True
    compaction: bool = False
    shift: bool = False
    close_shifted: bool = False
    prune: bool = False
    date_suffix: str = DATE_SUFFIX
    pattern: str | None = NAME_PATTERN
    delta: int = 0
    min_to_keep: int = 0

    @classmethod
    def dated(cls, index: str, at: datetime | None = None, **switches) -> IndexDefinition:
        """A definition whose full name carries the UTC date."""
        moment = at or datetime.now(timezone.utc)
        suffix = format_date(moment, switches.get("date_suffix", DATE_SUFFIX))
        return cls(index=index, full_name=index + suffix, **switches)

    @classmethod
    def from_settings(cls, index: str, settings: Mapping[str, object], at: datetime | None = None) -> IndexDefinition:
        """Reads the switches from settings; only a shifting definition is dated, and only then prunes."""

        def setting(name: str, default=None):
            return settings.get(SETTING[name], default)

        def flag(name: str, default: bool) -> bool:
            value = setting(name, default)
            return value.lower() == "true" if isinstance(value, str) else bool(value)

        base = str(setting("name", index))
        common = {
            "mapping": setting("mapping"),
            "enabled": flag("enabled", True),
            "compaction": flag("compaction", True),
        }
        if not flag("shift", False):
            return cls(index=base, full_name=base, **common)
        prune = flag("prune", False)
        return cls.dated(
            base,
            at,
            shift=True,
            close_shifted=flag("close_shifted", False),
            prune=prune,
            date_suffix=str(setting("date_suffix", DATE_SUFFIX)),
            pattern=str(setting("pattern", NAME_PATTERN)),
            delta=int(setting("delta", DELTA)) if prune else 0,
            min_to_keep=int(setting("min_to_keep", MIN_TO_KEEP)) if prune else 0,
            **common,
        )

    def fields(self) -> list[str]:
        return field_names(self.mapping)

    def retention(self) -> Retention:
        on = self.enabled and self.prune and self.pattern is not None
        return Retention(self.index or "", self.full_name, self.delta, self.min_to_keep, on)
