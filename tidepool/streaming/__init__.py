"""Structured Streaming forms of the operators (watermarks, chained windows,
foreachBatch ranking, transformWithStateInPandas processors)."""
