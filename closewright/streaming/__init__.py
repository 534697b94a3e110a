"""Streaming: the close is a monthly batch; there is no streaming operator to express."""
