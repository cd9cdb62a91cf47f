"""Operators over text corpora for training-data pipelines; each module names its method."""
