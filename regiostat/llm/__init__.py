"""Training-data operators: scoring, mixing, filtering and deduplication of
a document corpus.  Nothing outside this package imports it."""
