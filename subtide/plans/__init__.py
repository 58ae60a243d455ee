"""Query registry, its SQL oracles, and shared plan shapes."""
