"""Composite plans: standardised sources, dimensions, facts, forecast, marts, whole loads."""
