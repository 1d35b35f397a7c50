"""Relational operators: everything here is ``DataFrame -> DataFrame``."""
