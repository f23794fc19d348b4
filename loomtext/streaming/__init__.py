"""The annotation of documents as they arrive: an extension, by the same operators as in batch."""
