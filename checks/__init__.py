"""Oracle SQL and the side-by-side check against it."""
