"""Feed documents, article messages and the processed table."""
