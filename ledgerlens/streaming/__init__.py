"""Streams of new panel rows."""
