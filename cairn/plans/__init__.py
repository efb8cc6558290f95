"""Query plans: registered queries, their SQL oracles and plan helpers."""
