"""Training-data operators for large text corpora, one module per operator."""
