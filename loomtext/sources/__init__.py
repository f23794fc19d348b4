"""Readers and writers: marked-up documents (``markup``), tables and sinks (``tables``)."""
