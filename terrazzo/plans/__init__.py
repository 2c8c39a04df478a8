"""Plan documents and the registered queries."""
