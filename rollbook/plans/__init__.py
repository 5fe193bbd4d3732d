"""The three end-to-end plans."""
