"""The visitor rules replayed row by row, as an independent check."""

from __future__ import annotations

import random
from datetime import datetime, timezone

COLUMNS = "seq bigint, userID string, channelID string, count bigint, timestamp bigint"


def text(ms: int, pattern: str) -> str:
    return datetime.fromtimestamp(ms / 1000, timezone.utc).strftime(pattern)


def blank(value) -> bool:
    return value is None or not value.strip()


def replay(rows, history=None):
    """Flags per row, in the order given; ``history`` maps visitors to their last time."""
    history = {} if history is None else history
    flags = {}
    for seq, user, channel, _, ms in rows:
        past = history.get((user, channel))
        if past is None or blank(user):
            flags[seq] = (1, 1, 1, 1)
        else:
            flags[seq] = (0, *[int(text(ms, p) > text(past, p))
                               for p in ("%Y%m%d%H", "%Y%m%d", "%Y%m")])
        if user is not None and channel is not None:
            history[(user, channel)] = ms
    return flags, history


def random_clicks(seed: int, n: int = 400):
    """Clicks that jump back and forth over months, half of them from one visitor."""
    rng = random.Random(seed)
    start = 1704067200000
    rows = []
    for seq in range(n):
        hot = rng.random() < 0.5
        user = "hot" if hot else rng.choice(["a", "b", "c", None, "", " \t", "\u3000"])
        channel = "x" if hot else rng.choice(["x", "y", None, " "])
        jump = rng.choice([3600_000, 86400_000, 20 * 86400_000])
        rows.append((seq * 3, user, channel, rng.randint(1, 3), start + rng.randint(0, 4) * jump
                     + rng.randint(0, 3599_999)))
    return rows


def flags_of(df):
    return {r.seq: (r.isNew, r.isHourNew, r.isDayNew, r.isMonthNew) for r in df.collect()}
