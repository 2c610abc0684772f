"""DataFrame-to-DataFrame operators over points, stays, traces, crowds and flows."""
