"""Offer decisioning on Spark: point-in-time features, scoring, rules, budgets, drift."""
