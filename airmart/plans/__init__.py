"""Tables built from the operators."""
