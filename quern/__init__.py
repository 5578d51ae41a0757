"""quern: a Spark engine that prepares text corpora for language-model training.

Every pass takes DataFrames and returns DataFrames.  Passes stay inside Catalyst
(Column expressions, joins, windows) unless a semantic rule cannot be written that way;
those use Arrow-batched Python.
"""

__version__ = "0.1.0"
