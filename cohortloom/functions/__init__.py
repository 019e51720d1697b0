"""Column functions: missing-value rules, scalar derivations, term calendar, tail probabilities."""
