"""Operators for text-corpus preparation; nothing outside this folder imports them."""
