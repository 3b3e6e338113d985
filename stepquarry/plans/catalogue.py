"""Imports every module that registers queries."""

from stepquarry.plans import figure_queries, nested_queries, text_queries  # noqa: F401

FLAGSHIP = "trial_gate_majority"
