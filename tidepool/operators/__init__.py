"""DataFrame → DataFrame operators; no state, no driver-side loops."""
