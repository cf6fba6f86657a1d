"""Training-data operators: ten operators over documents, pages, benchmark and
labels. Nothing outside this package imports it."""
