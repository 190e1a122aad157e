"""Change detection over snapshots: GAME_CHANGE / TITLE_CHANGE events (batch form).

Each snapshot is compared with the previous snapshot of the same stream. The
first sighting only sets the baseline; a gap longer than the idle limit ends a
session, so the next sighting is a first sighting again. The state moves on
every row, so viewer_delta is always against the immediately previous poll.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from livepulse.functions.constants import GAME_CHANGE, IDLE_HOURS, TITLE_CHANGE
from livepulse.operators.sequence import previous_row


def _text(c, null_text: str | None):
    c = c.cast("string")
    return c if null_text is None else F.coalesce(c, F.lit(null_text))


def detect_transitions(df: DataFrame, key: str = "stream_id", ts: str = "ingestion_ts",
                       game: str = "game_name", title: str = "title",
                       viewers: str = "viewer_count", user: str = "user_name",
                       idle_hours: float | None = IDLE_HOURS, tiebreak: Sequence[str] = (),
                       null_text: str | None = None, bucket_seconds: int = 86400) -> DataFrame:
    """Events with columns stream_id, user_name, event_type, old_value, new_value,
    event_ts, viewer_delta. A poll that changes both game and title gives two
    events, game first. Null compares equal to null (``<=>``). ``null_text``
    renders a null old/new value as text (e.g. "None"); default keeps null.
    """
    rows = (df.select(key, user, game, title, viewers, ts, *tiebreak)
            .where(F.col(ts).isNotNull() & F.col(key).isNotNull()))
    p = previous_row(rows, key, ts, [game, title, viewers], tiebreak, bucket_seconds)
    live = F.col(f"prev_{ts}").isNotNull()
    if idle_hours is not None:
        gap = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col(f"prev_{ts}").cast("timestamp"))
        live = live & (gap <= F.lit(int(idle_hours * 3600 * 1_000_000)))

    def ev(kind, col):
        changed = live & ~F.col(col).eqNullSafe(F.col(f"prev_{col}"))
        return F.when(changed, F.struct(F.lit(kind).alias("event_type"),
                                        _text(F.col(f"prev_{col}"), null_text).alias("old_value"),
                                        _text(F.col(col), null_text).alias("new_value")))

    events = F.filter(F.array(ev(GAME_CHANGE, game), ev(TITLE_CHANGE, title)), lambda x: x.isNotNull())
    return (p.where(live)
            .select(F.col(key).alias("stream_id"), F.col(user).alias("user_name"),
                    F.explode(events).alias("_e"), F.col(ts).alias("event_ts"),
                    (F.col(viewers) - F.col(f"prev_{viewers}")).cast("long").alias("viewer_delta"))
            .select("stream_id", "user_name", "_e.event_type", "_e.old_value", "_e.new_value",
                    "event_ts", "viewer_delta"))
