"""Operators: climate (B), market (C), events and topic (D), keyed table sink (E)."""
