"""Jobs over stored data, and the registered queries."""
