"""Structured Streaming helpers: life cycle, bounded reads, fan-out."""

from rillflow.streaming.bounded import read_bounded
from rillflow.streaming.fanout import fan_out
from rillflow.streaming.lifecycle import run_to_end

__all__ = ["fan_out", "read_bounded", "run_to_end"]
