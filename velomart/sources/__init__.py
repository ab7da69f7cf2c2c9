"""Readers: trip and station CSV, archives, pages, landed mart."""
