"""DataFrame operators: roll-ups, windows, features, reports, gates."""
