"""Operators for preparing training corpora: documents and web pages in, decisions and texts out."""
