"""Spark operators for voice-bot call data: turns, calls, annotations, reports."""
