"""Destination tables and the folders they live in."""
