"""DataFrame operators: harmonising, matching, counting, ordering, graph and ML."""
