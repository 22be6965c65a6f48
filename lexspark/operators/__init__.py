"""DataFrame operators: validation, comparison, updates, trees, ordering."""
