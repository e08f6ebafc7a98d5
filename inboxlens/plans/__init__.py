"""The named query catalogue and its SQL oracle."""
