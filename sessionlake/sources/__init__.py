"""Readers of session logs, review inputs, trial results and file trees."""
