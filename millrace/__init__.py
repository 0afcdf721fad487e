"""millrace: plant-telemetry features and laboratory conforming as Spark DataFrame plans."""

__version__ = "0.1.0"
