"""Incremental synchronisation, changes applied as they come, and event windows."""

from .latest import apply_changes, current_rows
from .sync import event_windows, incremental, sessions

__all__ = ["apply_changes", "current_rows", "event_windows", "incremental", "sessions"]
