"""Query plans: the model graph and the registered queries."""
