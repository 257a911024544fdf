"""Whole workflows: the summary store, batch loads, views, and the registered queries."""
