"""DataFrame operators, sources, sinks and jobs for product analytics on a data lake."""
