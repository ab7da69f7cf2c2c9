"""Trip analytics as plain DataFrame functions."""
