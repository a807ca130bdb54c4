"""Dataset operators: ``DataFrame... -> DataFrame``."""
