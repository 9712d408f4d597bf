"""Running the layers as Structured Streaming queries."""
