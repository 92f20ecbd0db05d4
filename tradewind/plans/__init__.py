"""Jobs composed from operators: each returns a DataFrame plan."""
