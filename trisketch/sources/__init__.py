"""Inputs: edge lists, integer items, and the graphs and streams read from tables."""
