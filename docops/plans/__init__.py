"""Skew-aware plan helpers and the registered queries."""
