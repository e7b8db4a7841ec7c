"""Feed normalisers, reporting datasets, checks, and the registered queries."""
