"""Reading and writing the log, its user-wise split, and the feature table."""
