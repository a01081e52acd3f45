"""Operators for preparing training corpora: toxicity, SentencePiece coding, near and exact
de-duplication, packing, sharding, embedding near-dedup, token counts, language
identification and binary materialisation.

Nothing else in the library imports this package. Each module holds one operator with a
general interface; ``queries.py`` holds the thin registered queries over the given tables.
"""
