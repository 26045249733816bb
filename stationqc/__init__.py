"""Spark-native quality scoring of weather-station telemetry."""

from stationqc.plans.fleet import score_fleet

__all__ = ["score_fleet"]
