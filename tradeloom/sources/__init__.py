"""Readers, parsers, validators and table writers."""
