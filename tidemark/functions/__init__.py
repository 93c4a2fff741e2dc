"""SQL and Python functions registered in a session."""
