"""Stage-level jobs built from the operators."""
