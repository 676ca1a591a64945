"""Jobs composed from the operators, and the table mapping used by tests/bench."""
