"""DataFrame operators over many samples at once."""
