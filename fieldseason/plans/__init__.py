"""Compositions of operators into whole-layer plans, and the registered queries."""
