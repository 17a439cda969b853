"""Whole jobs made of the operators, with written tables between the steps that are read twice."""
