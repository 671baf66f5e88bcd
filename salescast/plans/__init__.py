"""Jobs that chain the operators, the query catalogue and its SQL oracle."""
