"""Operators for preparing training data; each is one module, with its query beside it in ``queries``."""
