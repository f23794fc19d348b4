"""Annotation and lexical analytics of text corpora and marked-up documents, as Spark plans."""
