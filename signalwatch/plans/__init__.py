"""Operators put together: star schema, features, models and reports."""
