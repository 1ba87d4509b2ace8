"""Table specs, layer runners and the registered queries."""
