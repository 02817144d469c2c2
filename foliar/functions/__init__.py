"""Column functions: missing-value rules, text parsing, units and cleaning."""
