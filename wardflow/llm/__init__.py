"""Operators for preparing training corpora (language, archives, tokens, packing, duplicates, search)."""
