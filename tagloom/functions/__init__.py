"""functions of the library."""
