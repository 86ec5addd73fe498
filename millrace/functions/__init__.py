"""Column functions: ``Column -> Column``, no shuffle, no action."""
