"""Training-data operators: token counts, de-duplication, quality, mixing, packing, filters, fixity.

Nothing outside this subpackage imports it.  ``catalog.py`` registers the
queries; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
