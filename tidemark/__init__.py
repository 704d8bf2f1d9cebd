"""Warehouse loading patterns and data-quality checks as Spark jobs.

Every public function takes and returns DataFrames; nothing runs until the
caller acts on the result, except the writers in ``sources`` and ``streaming``.
"""
