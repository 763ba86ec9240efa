"""Operators of a training-data pipeline: packing, token files, exact and
near deduplication, chat formatting, byte-level BPE, nearest neighbours,
language ID, token counts and repeated-passage removal.

Nothing outside this subpackage imports it.  Every operator takes and
returns DataFrames; ``queries`` holds the registered queries.
"""
