"""Sensor-log analytics and remaining-useful-life features as Spark jobs."""
