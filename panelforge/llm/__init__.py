"""Training-data operators: chat collapse, search, scoring, cleaning, dedup, packing.

Nothing else in ``panelforge`` imports this subpackage.
"""
