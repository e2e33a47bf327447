"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it.  Every operator is a
``DataFrame -> DataFrame`` function: Spark partitions, shuffles and joins; the
per-batch work inside ``mapInArrow`` is numpy over the Arrow buffers, in slices
of bounded size.
"""
