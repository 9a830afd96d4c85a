"""Staging views, marts and the reports on them."""
