"""Query plans over the driver tables: profile views, the query registry, oracles."""
