"""Structured Streaming: refresh the daily revenue mart as files arrive."""

from martwright.streaming.daily_revenue import read_landing, start_daily_revenue

__all__ = ["read_landing", "start_daily_revenue"]
