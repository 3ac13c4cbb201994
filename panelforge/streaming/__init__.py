"""Structured Streaming entry points.

The reference is a bounded batch pipeline: it has no streams, watermarks or
state, so nothing here adds an operator.  What carries over is that every
fitted preparation step (:class:`FillValues`, :class:`StandardScale`) and a
fitted Spark ML model are stateless per-row transforms, so the same fitted
objects score a ``readStream`` of landed feature rows exactly as they score
a batch table.
"""

from .scoring import score_stream  # noqa: F401
