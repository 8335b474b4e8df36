"""Registered queries, each beside the plain SQL it has to agree with."""
