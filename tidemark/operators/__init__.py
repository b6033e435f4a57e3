"""DataFrame operators of the bronze, silver and gold layers."""
