"""DataFrame -> DataFrame operators: checks, linking, features, raking,
forecast producers, ensemble, lookups, metrics and reports."""
