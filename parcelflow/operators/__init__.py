"""DataFrame -> DataFrame operators.  No I/O here."""
