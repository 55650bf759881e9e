"""DataFrame operators: lookups, as-of and curve joins, schedules, states, shapes."""
