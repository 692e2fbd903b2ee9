"""functions of the session analytics engine."""
