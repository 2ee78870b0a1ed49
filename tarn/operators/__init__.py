"""DataFrame operators: landing, homogenising, quality, vectors, retrieval."""
