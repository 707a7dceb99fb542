"""Data products: the tables a user of the library asks for."""
