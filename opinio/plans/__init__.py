"""The layered job, its declarative form and the registered queries."""
