"""Metric models, saved questions and the ordered refresh chain."""
