"""Operators for building training corpora: tokenisation, mixing, filtering, duplicate search."""
