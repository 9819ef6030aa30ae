"""Ranked waves: try candidates in rank order until enough of them succeed, without trying one by one.

A wave is a prefix of the ranks that are left. It is tried as a whole, its successes are counted, and the next
wave is as long as the successes still missing need at the rate seen so far. The wave in which the last
success falls is cut behind it, so what is handed on is what a run that tries one candidate after the other
and stops at its limit would have done: what was tried beyond is forgotten and stays open.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import durable

from .ranking import global_rank

#: How much longer than the one before a wave may be, however few succeeded.
GROWTH = 8


def wave_size(missing: int, tried: int, good: int, before: int, least: int) -> int:
    """Candidates that should bring ``missing`` successes after ``good`` of ``tried``; ``before``: the last wave's size."""
    wanted = math.ceil(missing * (tried + 1) / (good + 1))
    return max(least, min(wanted, GROWTH * before) if before else missing)


def ranked_waves(ranked: DataFrame, attempt: Callable[[DataFrame], DataFrame], limit: int | None, *, already: int = 0, rank: str = "rank", least: int = 1000) -> Iterator[DataFrame]:
    """Durable outcomes, wave by wave, until ``limit`` successes, of which ``already`` were there before.

    ``ranked`` has gapless places from 1 in ``rank``. ``attempt`` gets the rows of a wave and returns a row for each
    with its ``rank``, ``ok`` and whatever it made. Without ``limit`` one wave takes all rows. An empty table, and a
    limit that is reached before, give no waves.
    """
    ranked = durable(ranked)
    total, at, good, size = ranked.count(), 0, 0, 0
    while at < total and (limit is None or already + good < limit):
        missing = None if limit is None else limit - already - good
        size = total if missing is None else wave_size(missing, at, good, size, least)
        place = F.col(rank)
        outcome = durable(attempt(ranked.where((place > at) & (place <= at + size))))
        found = outcome.where("ok").count()
        if missing is not None and found >= missing:
            last = global_rank(outcome.where("ok").select(rank), [F.asc(rank)], "_nth").where(F.col("_nth") == missing).first()[rank]
            yield outcome.where(place <= last)
            return
        yield outcome
        at, good = at + size, good + found
