"""The reports, one module per business question, and the batch job that writes them all."""
