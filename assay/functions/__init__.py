"""Building blocks: parameters, type names, rules and their Spark expressions."""
