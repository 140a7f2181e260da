"""Reading and writing document, vector, graph and topic tables."""
