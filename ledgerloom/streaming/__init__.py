"""The batch operators over files as they arrive."""
