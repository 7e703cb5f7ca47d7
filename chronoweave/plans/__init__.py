"""Checks, scores, alignment, datasets and tiers built from the operators, and the registered queries."""
