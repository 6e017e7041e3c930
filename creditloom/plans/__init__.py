"""The credit domain, composed from the generic operators."""
