"""failcast: failure forecasting over container telemetry, as lazy Spark plans."""

__version__ = "0.1.0"
