"""Reading and writing: landing directories, contracts, layered tables, shared scratch space."""
