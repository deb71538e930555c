"""Column builders: run normalisation, dates, request checks."""
