"""Source operators (S1-S21) and the test-data role adapters."""
