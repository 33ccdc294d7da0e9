"""Readers for bronze feeds and the shared working folder."""
