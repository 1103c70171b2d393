"""Table bindings, registered queries and their SQL twins."""
