"""Incremental evaluation of score streams (Structured Streaming).

The reference has no streaming input; this module runs the same one-pass
metric state (V02/V04 buckets) incrementally over files that keep arriving.
"""

from tessera.streaming.monitor import sweep_state_stream, threshold_sweep_from_state  # noqa: F401
