"""Training-data operators: one module for each, nothing outside this subpackage imports them."""
