"""Training-data operators: one module each, registered in queries.py."""
