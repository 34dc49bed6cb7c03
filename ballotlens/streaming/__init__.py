"""Streaming: file-stream driven incremental epoch maintenance."""

from ballotlens.streaming.incremental import refresh_epochs, start_epoch_stream  # noqa: F401
