"""DataFrame-to-DataFrame operators over the catalog tables."""
