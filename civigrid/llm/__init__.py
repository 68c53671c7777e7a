"""Operators for preparing training data: de-duplication, quality, language, licences, tokens and packing.

Nothing else in the library imports this subpackage.
"""
