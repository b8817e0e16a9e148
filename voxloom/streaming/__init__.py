"""The same operators on unbounded input."""
