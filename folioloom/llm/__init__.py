"""Operators for making training data out of a lake of documents."""
