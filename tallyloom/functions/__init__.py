"""Column-to-Column building blocks; none of them starts a job or a Python worker unless it says so."""
