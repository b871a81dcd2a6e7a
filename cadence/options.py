"""Job options: one frozen dataclass instead of a command-line framework."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class JobOptions:
    # Defaults equal the reference's: topic "songs", 20 s gap, 5 s early-fire interval,
    # every analysis on, one output topic per analysis.
    topic: str = "songs"
    session_gap_s: int = 20
    trigger_interval_s: int = 5
    session_stats: bool = True
    discover_weekly: bool = True
    subsession_stats: bool = True
    early_panes: bool = True
    session_write_topic: str = "session-stats"
    discover_weekly_write_topic: str = "discover-weekly-stats"
    subsession_write_topic: str = "subsession-stats"
    # The dialect of results and messages.
    # "window": end = last event + gap, duration includes the gap; early panes if asked for.
    # "span":   duration = last - first, no gap; each session is reported once, when it ends.
    dialect: str = "window"
    merge_touching: bool = True

    def __post_init__(self) -> None:
        if self.dialect not in ("window", "span"):
            raise ValueError("dialect must be 'window' or 'span'")

    @property
    def panes(self) -> bool:
        """Whether sessions are reported by early panes."""
        return self.session_stats and self.early_panes and self.dialect == "window"

    @property
    def gap_ms(self) -> int:
        return self.session_gap_s * 1000

    @property
    def interval_ms(self) -> int:
        return self.trigger_interval_s * 1000
