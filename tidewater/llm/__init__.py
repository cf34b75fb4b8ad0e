"""Operators and queries for a training-data pipeline; nothing else imports this package."""
