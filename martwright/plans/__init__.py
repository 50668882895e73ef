"""The models, reports and check suites, composed from the operators."""
