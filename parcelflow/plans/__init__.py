"""Query plans over the test tables, jobs over the ledger tables, and sinks."""
