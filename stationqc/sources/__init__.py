"""Reading, shaping and writing telemetry tables."""
