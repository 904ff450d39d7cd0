"""Batch and Structured Streaming building blocks for keyed, windowed data pipelines.

The package is a set of plain ``DataFrame -> DataFrame`` functions:

* ``sources``   readers, writers and generators
* ``functions`` column expressions (text, time, arrays, payloads, messages)
* ``operators`` grouping, joins, batching, routing, cells, windows and pane replay
* ``streaming`` stateful processors and end-to-end streaming flows
* ``plans``     the registered queries with their SQL oracles
"""

from millrace.session import build_session, prepare, scratch_path

__all__ = ["build_session", "prepare", "scratch_path"]
