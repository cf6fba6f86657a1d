"""DataFrame operators: dictionaries, postings, change log, search."""
