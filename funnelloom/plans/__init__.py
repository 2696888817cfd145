"""End-to-end board results, composed from the operators."""
