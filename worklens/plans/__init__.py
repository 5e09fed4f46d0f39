"""Report datasets built from the operators (one module per report family)."""
