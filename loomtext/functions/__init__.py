"""Column functions: script and orthography (``georgian``), strings, dates and references (``strings``)."""
