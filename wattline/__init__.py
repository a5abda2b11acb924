"""Sensor-telemetry analytics as DataFrame-to-DataFrame operators and the jobs that chain them."""
