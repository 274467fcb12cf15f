"""Table operators: lazy ``DataFrame`` in, lazy ``DataFrame`` out."""
