"""Operators for preparing training corpora (dedup, scans, quality, packing, tokens, archives)."""
