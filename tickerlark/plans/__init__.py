"""Whole flows, the registered queries and their independent SQL."""
