"""DataFrame-to-DataFrame operators that the data products are composed from."""
