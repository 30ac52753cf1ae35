"""Composed jobs: the batch chain, training, and the registered queries."""
