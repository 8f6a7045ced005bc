"""Query plans over the supplied tables and their SQL oracles."""
