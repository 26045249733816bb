"""The registered queries, their telemetry view and their SQL counterparts."""
