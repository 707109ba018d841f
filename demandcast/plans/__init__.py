"""Query plans: shared derived inputs, the registered queries, their SQL
oracles and the weekly pipeline run."""
