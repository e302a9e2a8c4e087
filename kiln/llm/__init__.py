"""Operators of a training-data pipeline.

One module per operator; ``queries`` registers one ``opN_<name>`` query for
each.  Nothing outside this package imports it, except the guarded entry
module and ``corpus_pipeline``."""
