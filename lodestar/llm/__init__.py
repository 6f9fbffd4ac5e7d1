"""Operators for preparing large training corpora (documents, urls, vectors, token files)."""
