"""Declarations: what an entity is, the eight shipped entities and the contract queries."""
