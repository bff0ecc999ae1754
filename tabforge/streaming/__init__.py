"""Streaming: intentionally empty.

The workload this package rebuilds is batch only (no watermarks, windows over
event time, or state), so there is no streaming operator to provide.  Fitted
models are plain column expressions and can be applied to a streaming
DataFrame with ``model.transform`` like any other projection.
"""
