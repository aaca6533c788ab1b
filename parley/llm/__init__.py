"""Operators for building training corpora from document, page and vector tables."""
