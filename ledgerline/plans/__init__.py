"""Composite jobs, views and the registered query set."""
