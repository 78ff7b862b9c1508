"""Inputs: table resolver for chain data and fixture encoders."""
