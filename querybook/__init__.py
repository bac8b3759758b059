"""Every operator run over the given tables, each with an independent SQL statement of its result."""
