"""Training-data pipeline operators: one module per operator, ``queries`` and ``oracle`` register them."""
