"""operators of the session analytics engine."""
