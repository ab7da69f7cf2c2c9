"""The mart build, the reports over it, and publishing them all."""
