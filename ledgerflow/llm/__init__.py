"""Operators for training-data pipelines over text tables.

Nothing outside this package imports it.  Python parts run inside Spark tasks
on Arrow batches; what they keep is bounded by a batch, a block or a
documented parameter, and a lost task is simply run again.
"""
