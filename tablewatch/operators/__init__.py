"""DataFrame -> DataFrame operators: slices, metrics, profiles, rules, verification, drift, history."""
