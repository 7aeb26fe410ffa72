"""quire: book-length document processing as composable Spark DataFrame transformations."""
