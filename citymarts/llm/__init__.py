"""Training-data operators (one module per operator) and their registered queries."""
