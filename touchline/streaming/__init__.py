"""Structured Streaming: incremental, checkpointed file ingest."""

from touchline.streaming.ingest import stream_delimited

__all__ = ["stream_delimited"]
