"""Operators for training-data pipelines: text in, decisions, signatures, token ids and scores out."""
