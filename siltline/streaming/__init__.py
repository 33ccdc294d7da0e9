"""Keyed targets and the Structured Streaming runner that maintains them."""
