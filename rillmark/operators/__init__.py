"""DataFrame transformations: changes, quality, integrity, series, rules and alerts."""
