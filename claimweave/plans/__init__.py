"""Whole jobs: the nightly chain and the registered queries."""
