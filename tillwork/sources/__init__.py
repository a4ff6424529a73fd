"""Input relations, their contracts, and reading and writing them."""
