"""Run parameters that the reference takes from the clock.

The reference calls ``current_date()`` / ``current_timestamp()`` inside its
models; results then depend on the day they run.  We pass both in instead so
that a run is reproducible and comparable.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class RunParams:
    as_of_date: dt.date = dt.date(2001, 6, 30)
    run_ts: dt.datetime = dt.datetime(2001, 7, 1, 0, 0, 0)


DEFAULT = RunParams()
