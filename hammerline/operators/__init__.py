"""Query services, each a set of DataFrame plans."""
