"""Operators for preparing training text: ten of them, each with its query in ``queries``."""
