"""Models of the four layers and the registry that builds them."""
