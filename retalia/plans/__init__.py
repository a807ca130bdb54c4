"""The operators put together."""
