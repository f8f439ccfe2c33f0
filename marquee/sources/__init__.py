"""Readers and writers for catalogs, index tables, vectors and hit lists."""
