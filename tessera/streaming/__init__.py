"""Streaming (watermark) and micro-batch (foreachBatch) dedupe."""
