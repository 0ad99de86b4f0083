"""Streaming: the reference processes no streams (no stream source, watermark or state).

The one streaming form kept here is the bronze ingest (S1 + S4) run incrementally with
Structured Streaming's file source: each new raw file is appended once, tracked by the
stream's checkpoint. Batch ingest stays the default.
"""
