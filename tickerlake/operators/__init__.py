"""Marts and operators, each a lazy DataFrame -> DataFrame function."""
