"""Operators for training data: golden records, value mapping, packing, leakage and toxicity."""
