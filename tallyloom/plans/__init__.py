"""Plan patterns that keep ordered and time-based work partitioned."""
