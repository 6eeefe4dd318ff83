"""Checks of the library on the driver tables: match-shaped views, queries, oracle SQL."""
