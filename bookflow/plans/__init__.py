"""Registered queries and the equivalent SQL."""
