"""Complete jobs, and the check queries with their SQL oracles."""
