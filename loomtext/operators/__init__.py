"""Operators on tokens, lookups, matches, attestations, catalogues and markup; each takes and returns DataFrames."""
