"""Operators for preparing training corpora: dedup, tokens, quality, privacy, licences, shards."""
