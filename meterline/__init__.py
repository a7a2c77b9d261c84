"""Ride-stream analytics as DataFrame operators, for batch tables and for Structured Streaming."""
