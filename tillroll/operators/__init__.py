"""Distributed building blocks that serve any table: column names are parameters."""
