"""Session settings, registered queries and their SQL counterparts."""
