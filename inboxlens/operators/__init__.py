"""Pure DataFrame -> DataFrame operators (no I/O, no collect)."""
