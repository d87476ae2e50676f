"""Operators for data of language models: each works on whole tables and is imported by nothing else in the library."""
