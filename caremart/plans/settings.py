"""Parameters of a load."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class LoadSettings:
    """Dates, site names and the seed of a load.

    ``run_date`` opens the validity of dimension rows, so a rerun of the same day gives the same
    tables. ``zone_sante`` names the health zone of the site (NULL unless set).
    """

    run_date: dt.date = field(default_factory=dt.date.today)
    calendar_start: dt.date = dt.date(2024, 1, 1)
    calendar_end: dt.date = dt.date(2026, 12, 31)
    ville: str = "Lubumbashi"
    zone_sante: str | None = None
    seed: int = 0
