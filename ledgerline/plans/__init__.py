"""Plans: the claims overlay, the medallion pipeline and the registered queries."""
