"""Which output days a changed input day reaches.

A job's output of day D reads its tables at D plus some offsets: the next day for broadcasts that run
past midnight, one and seven days before for retention, the whole history for the user profile.  Read
backwards, rows that arrive late for day X change the output days X minus each offset, and these are
changed input days of the jobs that read the output.  ``affected_days`` follows that through the chain
of jobs, so that a late file rewrites exactly the days it reaches.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Iterable, Mapping, Sequence

#: Offsets of a table that is read from its beginning up to the output day.
HISTORY = "history"

#: job -> table -> the days it reads for an output day, as offsets from it.
READS: dict[str, dict[str, tuple[int, ...] | str]] = {
    "ods_play_time": {"play_time_raw": (0,)},
    "ods_online_count": {"online_raw": (0,)},
    "dw_room_online_count": {"online_count": (0,)},
    "dw_daily_room_flow": {"online_raw": (0,), "room_pv_uv": (0,), "trade": (0,), "subscription": (0,),
                           "subscription_total": (0,), "player_log": (0,), "play_time_raw": (0,)},
    "dw_room_play_time": {"play_time_etl": (0,), "online_count": (0, 1), "page_view": (0, 1), "trade": (0, 1),
                          "player_log": (0, 1), "room_pv_uv": (0,)},
    "dw_user_transaction": {"trade": HISTORY},
    "rpt_channel_analysis": {"pv_track": (0, -1, -7)},
    "rpt_source": {"pv_track": (0, -1, -7), "page_view": (0,)},
    "rpt_user_cnt_by_category": {"page_view": (0,)},
}

#: Tables without days: a change of theirs is no late day.
DIMENSIONS = ("dim_room", "dim_category")


@dataclass(frozen=True)
class JobRun:
    """One scheduled job: the tables it reads (name in ``READS`` -> path), where it writes, its options."""
    job: str
    tables: Mapping[str, str]
    out: str
    options: Mapping = field(default_factory=dict)


def in_order(runs: Sequence[JobRun]) -> list[JobRun]:
    """The runs so that every job comes after those whose output it reads."""
    left, done = list(runs), []
    while left:
        outs = {r.out.rstrip("/") for r in left}
        ready = [r for r in left if not outs & {p.rstrip("/") for p in r.tables.values()}]
        if not ready:
            raise ValueError("jobs read each other's output in a circle: " + ", ".join(r.job for r in left))
        done += ready
        left = [r for r in left if r not in ready]
    return done


def affected_days(runs: Sequence[JobRun], changed: Mapping[str, Iterable[dt.date]], first: dt.date,
                  last: dt.date) -> list[tuple[JobRun, list[dt.date]]]:
    """The runs to repeat, in order, each with exactly the output days in ``[first, last]`` that the
    ``changed`` days (path of a table -> days) reach."""
    dirty = {p.rstrip("/"): set(d) for p, d in changed.items()}
    todo = []
    for r in in_order(runs):
        days: set[dt.date] = set()
        for table, path in r.tables.items():
            offsets = () if table in DIMENSIONS else READS[r.job][table]
            for x in dirty.get(path.rstrip("/"), ()):
                if offsets == HISTORY:
                    days |= {x + dt.timedelta(days=i) for i in range((last - x).days + 1)}
                else:
                    days |= {x - dt.timedelta(days=o) for o in offsets}
        days = {d for d in days if first <= d <= last}
        if days:
            todo.append((r, sorted(days)))
            dirty.setdefault(r.out.rstrip("/"), set()).update(days)
    return todo
