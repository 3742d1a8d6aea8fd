"""Fixtures of the folder; the session comes from the folder above."""
