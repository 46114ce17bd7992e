"""Operators for training data: one module per operator, thin queries in ``queries``."""
