"""Cycle-level dataflows (F1, F2, F4, F5) and the registered queries."""
