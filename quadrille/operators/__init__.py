"""DataFrame to DataFrame operators; all lazy unless they stage a small table."""
