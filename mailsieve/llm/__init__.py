"""Operators for preparing training text: one module each, with their queries in ``queries``."""
