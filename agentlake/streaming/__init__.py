"""Structured Streaming forms of the per-task and per-pod operators.

All of them keep a few values of state per key and see one micro-batch of a
key at a time; bound a batch with ``maxFilesPerTrigger`` or
``maxOffsetsPerTrigger`` on the source. Rows of one batch are taken in ``seq``
or time order, batches in arrival order.
"""
