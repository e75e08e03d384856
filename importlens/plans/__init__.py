"""Plans over the driver tables: fixture views, query catalog, publish jobs."""
