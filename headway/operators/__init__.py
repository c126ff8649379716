"""DataFrame-to-DataFrame operators; "now" is always a parameter."""
