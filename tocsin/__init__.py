"""Deferred, reschedulable one-shot triggers on Spark."""
