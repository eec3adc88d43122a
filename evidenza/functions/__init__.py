"""Column functions: text, URLs, vectors, sentences and encoders."""
