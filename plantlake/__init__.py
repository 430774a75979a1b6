"""Batch analytics for plant equipment, production, maintenance, quality and sensor data."""
