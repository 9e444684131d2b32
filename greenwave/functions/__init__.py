"""Column and frame helpers that carry the engine's null, time and ordering rules."""
