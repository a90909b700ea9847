"""What the engine knows about record groups: names, types, states, facility columns."""
