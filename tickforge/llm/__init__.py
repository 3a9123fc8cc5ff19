"""Operators for training-data pipelines: one module per operator, each with
its general interface and the thin registered query (``query``)."""
