"""Jobs: they read stored tables, apply operators, and publish the results."""
