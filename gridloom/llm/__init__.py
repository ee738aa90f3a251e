"""Operators for language-model data: grouping matches, packing, mixing, and spam pages. Nothing else imports this."""
