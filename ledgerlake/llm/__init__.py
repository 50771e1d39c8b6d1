"""Training-data operators: whole-text, whole-table Spark jobs over documents, pages and vectors."""
