"""File-triggered incremental refresh (Structured Streaming)."""

from .refresh import start_refresh_stream

__all__ = ["start_refresh_stream"]
