"""Queries composed of the operators, with their SQL oracles."""
