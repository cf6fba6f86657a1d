"""Composed plans: request handling and the registered query catalogue."""
