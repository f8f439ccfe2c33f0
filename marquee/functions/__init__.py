"""Column functions: text analysis, scoring, vectors, markup, urls."""
