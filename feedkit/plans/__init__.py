"""Whole jobs made of the operators: feed loading, update stages, and the registered queries."""
