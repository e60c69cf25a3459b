"""Composed jobs: cleaning, features, check suites and the monthly run."""
