"""Request logs to read and sinks to write."""
