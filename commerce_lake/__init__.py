"""Marketplace order analytics on PySpark: ingest, model, check, analyse."""
