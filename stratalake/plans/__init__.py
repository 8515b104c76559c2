"""Whole flows: the health demo datasets and the registered queries."""
