"""The row-local operators and counters on an unbounded message table."""
