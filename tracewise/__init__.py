"""tracewise: service-metrics anomaly detection and root-cause analysis on Spark."""

__version__ = "0.1.0"
