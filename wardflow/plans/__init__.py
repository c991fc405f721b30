"""Composite jobs: the persisted scoring pipeline, training and the registered queries."""
