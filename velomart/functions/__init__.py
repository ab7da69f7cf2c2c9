"""Column functions: mixed-format dates, file names, links."""
