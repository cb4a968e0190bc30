"""Column functions; all of them are compositions of built-in expressions."""
