"""The analyses and their runner."""
