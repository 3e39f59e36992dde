"""Feature sets, fitted preparation and model plans built from the operators."""
