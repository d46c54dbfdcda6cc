"""Readers for landed files and the stage area, and table writers."""
