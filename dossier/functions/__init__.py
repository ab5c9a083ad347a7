"""Part of the library."""
