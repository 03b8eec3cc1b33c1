"""Operators for preparing training text: tokenisation, duplicates, decontamination,
page extraction, fingerprints, secrets, quality and language.

Nothing else in the library imports this subpackage.
"""
