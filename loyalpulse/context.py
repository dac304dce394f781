"""The parameters one run shares: its reference date and its documented switches."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from loyalpulse.rules import BUSINESS_ZONE


@dataclass(frozen=True)
class RunContext:
    """Reference date plus switches; replaying a date replays its run.

    ``pad_ids``         compare every tax id 11 wide; ``False`` leaves the lists and
                        credit ids as stored.
    ``flag_mode``       ``"merge"`` keeps one row per person with all their flags;
                        ``"split"`` first builds the rows a chain of full outer joins
                        would give and keeps the top-ranked one.
    ``week_key``        ``"iso"`` groups by Monday; ``"calendar"`` by Monday, calendar
                        year and ISO week, which splits the week across New Year.
    ``horizon_offset``  weeks skipped before the first forecast; 4 places horizons
                        5-8 on the four labelled weeks.
    ``strict_casts``    raise on unreadable numbers instead of giving NULL.
    ``draw_salt``       changes the draw without changing the date.
    """

    as_of: date
    tz: str = BUSINESS_ZONE
    pad_ids: bool = True
    flag_mode: str = "merge"
    week_key: str = "iso"
    horizon_offset: int = 0
    strict_casts: bool = False
    draw_salt: str = ""

    def __post_init__(self) -> None:
        if self.flag_mode not in ("merge", "split"):
            raise ValueError(f"unknown flag_mode {self.flag_mode!r}")
        if self.week_key not in ("iso", "calendar"):
            raise ValueError(f"unknown week_key {self.week_key!r}")

    @classmethod
    def today(cls, tz: str = BUSINESS_ZONE, **switches) -> RunContext:
        return cls(as_of=datetime.now(ZoneInfo(tz)).date(), tz=tz, **switches)

    @classmethod
    def literal(cls, as_of: date, tz: str = BUSINESS_ZONE) -> RunContext:
        """Every switch set to the behaviour of the scripts this engine replaces."""
        return cls(
            as_of=as_of,
            tz=tz,
            pad_ids=False,
            flag_mode="split",
            week_key="calendar",
            horizon_offset=4,
            strict_casts=True,
        )

    def day(self, lag: int) -> date:
        """The date ``lag`` days before the reference date."""
        return self.as_of - timedelta(days=lag)

    def but(self, **switches) -> RunContext:
        return replace(self, **switches)
