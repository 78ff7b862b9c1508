"""Streaming entry points. The token tables and the decoders are stateless
row transforms plus a static-side join, so they run unchanged on a streaming
``DataFrame`` (stream-static semi join)."""
