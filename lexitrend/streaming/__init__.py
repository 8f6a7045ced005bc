"""Structured Streaming operators (S1 resumable ingest, S2 period counts)."""
