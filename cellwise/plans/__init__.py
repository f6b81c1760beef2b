"""End-to-end flows and the registered checks over the driver tables."""
