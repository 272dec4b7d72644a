"""DataFrame operators over many series at once."""
