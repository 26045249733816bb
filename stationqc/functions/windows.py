"""Window frames over one station-day.

Frames with both ends moving re-scan the whole frame for every row. Most checks here need only counts or "the latest
... up to", which frames growing from the start of the series give in one pass; a count over a moving window is then
the difference of two growing counts.
"""

from __future__ import annotations

from collections.abc import Sequence

KEYS = ("device_id", "qod_date")

EVERYTHING = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
EARLIER = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def last_rows(n: int) -> str:
    """This row and the ``n`` above it."""
    return f"ROWS BETWEEN {n} PRECEDING AND CURRENT ROW"


def older_than(seconds: int) -> str:
    """Rows with a time before ``now - seconds``."""
    return f"RANGE BETWEEN UNBOUNDED PRECEDING AND {seconds + 1} PRECEDING"


def until(seconds: int) -> str:
    """Rows with a time up to ``now + seconds``."""
    return f"RANGE BETWEEN UNBOUNDED PRECEDING AND {seconds} FOLLOWING"


def last_seconds(seconds: int) -> str:
    """Moving window ``(now - seconds, now]``."""
    return f"RANGE BETWEEN {seconds - 1} PRECEDING AND CURRENT ROW"


def past_seconds(seconds: int) -> str:
    """Moving window ``[now - seconds, now)``."""
    return f"RANGE BETWEEN {seconds} PRECEDING AND 1 PRECEDING"


class Timeline:
    """The series of one station-day (or one of its variables) in time order."""

    def __init__(self, keys: Sequence[str] = KEYS, order: str = "sec") -> None:
        self.spec = f"PARTITION BY {', '.join(keys)} ORDER BY {order}"

    def over(self, function: str, frame: str = "") -> str:
        return f"{function} OVER ({self.spec} {frame})"

    def lag(self, value: str) -> str:
        return self.over(f"lag({value})")

    def lead(self, value: str) -> str:
        return self.over(f"lead({value})")
